"""Exact Jaccard join of word n-gram sets by prefix routing and tries."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlens.llm.common import shuffle_width, staged
from postlens.llm.components import components
from postlens.llm.wordhash import chunks, hash_shingles, hash_words, mix
from postlens.operators import likely_in, split_likely

SIZE = 4
PERCENT = 85
#: How often n-grams occur is counted in so many cells; it orders them, and any order gives the same links.
SKETCH_BITS = 20
SKETCH_BLOCKS = 64
#: Members of a trie; a probe with more partners meets several tries.
TRIE_MEMBERS = 1000
#: Members of a frequent n-gram in one block, and pairs that are looked at at a time.
BLOCK_MEMBERS, MEETINGS = 250, 1_000_000
#: A path is compared so many n-grams at a time.
STRIDE = 64

_NO_SET = 0


# ---- sets


def text_sets(texts: list[str], size: int = SIZE) -> list[np.ndarray]:
    """Of each text the distinct hashes of its n-grams, ascending; fewer words count as one n-gram, none as none."""
    words, starts = hash_words(texts)
    grams = hash_shingles(words, size)
    out = []
    for start, end in zip(starts[:-1], starts[1:]):
        if end - start >= size:
            out.append(np.unique(grams[start:end - size + 1]))
        elif end > start:
            out.append(hash_shingles(words[start:end], end - start))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out


def set_id(grams: np.ndarray) -> int:
    """The same for equal sets only, up to 64-bit chance; 0 for the empty set."""
    if not len(grams):
        return _NO_SET
    both = np.array([grams.sum(), mix(grams ^ np.uint64(0x5851F42D4C957F2D)).sum()], dtype=np.uint64)
    value = mix(both[:1] * np.uint64(0x9E3779B97F4A7C15) ^ mix(both[1:] + np.uint64(len(grams)))).astype(np.int64)[0]
    return int(value) or 1


def least_overlap(x: np.ndarray | int, y: np.ndarray | int, percent: int) -> np.ndarray | int:
    """Smallest intersection of sets of these sizes with 100 * intersection >= percent * union."""
    return -(-(percent * (x + y)) // (100 + percent))


def in_global_order(grams: np.ndarray, sketch: np.ndarray) -> np.ndarray:
    """Rare n-grams first, by the counts of the sketch, then by hash: one order for all documents."""
    return grams[np.argsort(sketch[(grams >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)], kind="stable")]


def frequency_sketch(docs: DataFrame, size: int = SIZE, once: bool = True) -> np.ndarray:
    """In how many documents the n-grams of each cell occur, or how often in all if not ``once`` in each. The size is fixed; blocks of it are summed by Spark."""
    cells = (1 << SKETCH_BITS) // SKETCH_BLOCKS

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(1 << SKETCH_BITS, dtype=np.int64)
        for batch in batches:
            for _, texts in chunks(batch):
                grams = np.concatenate(text_sets(texts, size)) if once else hash_shingles(hash_words(texts)[0], size)
                cell = grams >> np.uint64(64 - SKETCH_BITS)
                total += np.bincount(cell.astype(np.int64), minlength=1 << SKETCH_BITS)
        for k in range(SKETCH_BLOCKS):
            yield pd.DataFrame({"block": [k], "counts": [total[k * cells:(k + 1) * cells].tobytes()]})

    def add(block: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(c, dtype=np.int64) for c in block["counts"])
        return pd.DataFrame({"block": block["block"].iloc[:1], "counts": [total.tobytes()]})

    blocks = docs.select("text").mapInPandas(count, "block int, counts binary")
    rows = blocks.groupBy("block").applyInPandas(add, "block int, counts binary").collect()
    sketch = np.zeros(1 << SKETCH_BITS, dtype=np.int64)
    for r in rows:
        sketch[r["block"] * cells:(r["block"] + 1) * cells] = np.frombuffer(r["counts"], dtype=np.int64)
    return sketch


# ---- candidates


def _prefixes(sets: list[np.ndarray], nodes: list[int], sketch: np.ndarray, percent: int) -> pd.DataFrame:
    """The n-grams that a set is routed by: a set that links with it has one of them among its own."""
    parts = []
    for node, grams in zip(nodes, sets):
        n = len(grams)
        if n:
            length = n - -(-percent * n // 100) + 1
            parts.append((in_global_order(grams, sketch)[:length], node, n))
    if not parts:
        return pd.DataFrame({"gram": [], "pos": [], "size": [], "node": []}, dtype="int64")
    lengths = [len(p[0]) for p in parts]
    return pd.DataFrame({
        "gram": np.concatenate([p[0] for p in parts]).view(np.int64),
        "pos": np.concatenate([np.arange(k) for k in lengths]),
        "size": np.repeat([p[2] for p in parts], lengths),
        "node": np.repeat(np.array([p[1] for p in parts], dtype=np.int64), lengths)})


def _may_link(size: np.ndarray, pos: np.ndarray, other_size: np.ndarray, other_pos: np.ndarray, percent: int) -> np.ndarray:
    """Whether two sets can link whose first common n-gram is at these places.

    By the remaining lengths; and the shorter set has it early enough to be found by
    its shorter, index prefix.
    """
    need = least_overlap(size, other_size, percent)
    small, small_pos = np.minimum(size, other_size), np.where(size <= other_size, pos, other_pos)
    small_pos = np.where(size == other_size, np.minimum(pos, other_pos), small_pos)
    return ((100 * small >= percent * np.maximum(size, other_size)) & (np.minimum(size - pos, other_size - other_pos) >= need)
            & (small_pos <= small - least_overlap(small, small, percent)))


def _first_candidates(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs of each set with the first of its n-gram (kind 0), and the members of n-grams with three sets or more (kind 1).

    Reads rows sorted by n-gram and place; the first is the set for which the n-gram
    comes earliest, in a family of edited copies the original. It alone is remembered.
    """
    def pair(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        gram = lead = None
        held: pd.DataFrame | None = None  # the first two rows of the last n-gram, until a third comes
        count = 0
        for batch in batches:
            batch = batch[(batch[["gram", "node"]] != batch[["gram", "node"]].shift()).any(axis=1)]
            if lead is not None and len(batch) and batch["gram"].iloc[0] == gram:
                batch = batch[~((batch["gram"] == gram) & (batch["node"] == lead["node"]))]
            if not len(batch):
                continue
            g = batch["gram"].to_numpy()
            new = np.concatenate(([True], g[1:] != g[:-1]))
            carried = g[0] == gram
            if carried:
                new[0] = False
            first = np.maximum.accumulate(np.where(new, np.arange(len(g)), -1))
            lead_of = {c: np.where(first < 0, lead[c] if carried else 0, batch[c].to_numpy()[np.maximum(first, 0)])
                       for c in ("node", "pos", "size")}
            node, pos, size = (batch[c].to_numpy() for c in ("node", "pos", "size"))
            link = (node != lead_of["node"]) & _may_link(size, pos, lead_of["size"], lead_of["pos"], percent)
            # members of groups that reach three
            group = np.cumsum(new)
            sizes = np.bincount(group)
            before = count if carried else 0
            if carried:
                sizes[0] += before
            member = (sizes >= 3)[group]
            out = [pd.DataFrame({"kind": 0, "gram": 0, "a": lead_of["node"][link], "b": node[link], "pos": 0, "size": 0})]
            if carried and before < 3 <= sizes[0] and held is not None:
                out.append(pd.DataFrame({"kind": 1, "gram": held["gram"], "a": held["node"], "b": 0, "pos": held["pos"], "size": held["size"]}))
            out.append(pd.DataFrame({"kind": 1, "gram": g[member], "a": node[member], "b": 0, "pos": pos[member], "size": size[member]}))
            last = batch[group == group[-1]]
            if group[-1] == 0:  # still the carried n-gram
                count = int(sizes[0])
                held = pd.concat([held, last]).iloc[:2] if count < 3 else None
            else:
                count = int(sizes[-1])
                held = last if count < 3 else None
                lead = {c: last[c].iloc[0] for c in ("node", "pos", "size")}
            gram = g[-1]
            yield pd.concat(out)

    return rows.mapInPandas(pair, "kind int, gram long, a long, b long, pos int, size int")


def _other_candidates(members: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b), a below b, of an n-gram's sets that are not in one component yet and may link.

    members: gram, a, pos, size, component. Most members of a frequent n-gram are in its
    largest component, and pairs within that are never formed: all members are dealt to blocks, and only those of
    the other components visit every block. A block holds so many members; visitors pass by.
    """
    spark = members.sparkSession
    counts = members.groupBy("gram", "component").agg(F.count("*").alias("n"))
    grams = counts.groupBy("gram").agg(F.sum("n").alias("all"), F.max("n").alias("most"), F.max_by("component", F.struct("n", "component")).alias("main"))
    mixed = grams.where("all > most").select("gram", "main", F.ceil(F.col("all") / BLOCK_MEMBERS).alias("blocks"))
    rows = staged(members.join(mixed, "gram"), "mixed")
    columns = ["gram", "block", "visits", "a", "pos", "size", "component", "main"]
    homes = rows.withColumn("block", F.pmod(F.xxhash64("a"), F.col("blocks"))).withColumn("visits", F.lit(0)).select(*columns)
    visits = (rows.where("component <> main").withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
              .withColumn("visits", F.lit(1)).select(*columns))
    dealt = homes.unionByName(visits).repartition(shuffle_width(spark), "gram", "block").sortWithinPartitions("gram", "block", "visits")

    def meet(home: np.ndarray, guests: np.ndarray) -> Iterator[pd.DataFrame]:
        step = max(1, MEETINGS // max(1, len(home)))
        for at in range(0, len(guests), step):
            x, y = guests[at:at + step, None, :], home[None, :, :]
            # two that both visit meet in each other's block
            new = (y[..., 3] == y[..., 4]) | (x[..., 0] < y[..., 0])
            link = (x[..., 3] != y[..., 3]) & new & _may_link(x[..., 2], x[..., 1], y[..., 2], y[..., 1], percent)
            i, j = np.nonzero(link)
            if len(i):
                one, other = x[i, 0, 0], y[0, j, 0]
                yield pd.DataFrame({"a": np.minimum(one, other), "b": np.maximum(one, other)})

    def by_block(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, home = None, np.zeros((0, 5), dtype=np.int64)
        for batch in batches:
            values = batch[columns].to_numpy()
            start = np.flatnonzero(np.concatenate(([True], (values[1:, :2] != values[:-1, :2]).any(axis=1)))) if len(values) else []
            for first, end in zip(start, [*start[1:], len(values)]):
                part = values[first:end]
                if tuple(part[0, :2]) != key:
                    key, home = tuple(part[0, :2]), np.zeros((0, 5), dtype=np.int64)
                home = np.concatenate([home, part[part[:, 2] == 0, 3:]])
                yield from meet(home, part[part[:, 2] == 1, 3:])

    return dealt.mapInPandas(by_block, "a long, b long").distinct()


# ---- an exact bound by signatures


def signature(grams: np.ndarray) -> bytes:
    """A bit for each n-gram, by hash; twice as many bits as n-grams, or up to four times, a power of two."""
    size = 1 << max(6, (2 * len(grams) - 1).bit_length())
    bits = np.zeros(size, dtype=np.uint8)
    bits[(grams & np.uint64(size - 1)).astype(np.int64)] = 1
    return np.packbits(bits).tobytes()


def may_agree(n_a: int, a: bytes, n_b: int, b: bytes, percent: int) -> bool:
    """False only if sets of these sizes and signatures surely don't link.

    Each bit that one has and the other lacks is an n-gram that they don't share. The
    longer signature is folded to the length of the other, which keeps that true.
    """
    x, y = (np.frombuffer(s, dtype=np.uint8) for s in (a, b))
    while len(x) > len(y):
        x = x[:len(x) // 2] | x[len(x) // 2:]
    while len(y) > len(x):
        y = y[:len(y) // 2] | y[len(y) // 2:]
    need = least_overlap(n_a, n_b, percent)
    return bool(np.bitwise_count(x & ~y).sum() <= n_a - need and np.bitwise_count(y & ~x).sum() <= n_b - need)


def _possible(pairs: DataFrame, docs: DataFrame, classes: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs that signatures don't rule out. A signature is a thirtieth of its set or less, so sets travel only for what is left."""
    def describe(node: int, grams: np.ndarray) -> tuple:
        return node, len(grams), signature(grams)

    signs = staged(_of_nodes(docs, pairs, classes, size, describe, "node long, n long, sign binary"), "signatures")
    rows = pairs
    for side in ("a", "b"):
        rows = rows.join(signs.select(F.col("node").alias(side), F.col("n").alias(f"n_{side}"), F.col("sign").alias(f"sign_{side}")), side)

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            kept = [may_agree(*row, percent) for row in zip(batch["n_a"], batch["sign_a"], batch["n_b"], batch["sign_b"])]
            yield batch.loc[np.array(kept, dtype=bool), ["a", "b"]]

    return staged(rows.select("a", "b", "n_a", "sign_a", "n_b", "sign_b").mapInPandas(check, "a long, b long"), "pairs")


# ---- verification by tries


def trie_links(probe: np.ndarray, members: list[np.ndarray], percent: int) -> list[int]:
    """Which members link with the probe. All sets are in one global order.

    The sorted members with the lengths of their common beginnings are a trie in
    an array. It is walked depth first: what the probe shares with a path is counted
    once for all members below, and where the remaining length can't make up for what
    is missing, everything below that point is skipped.
    """
    def too_few(at: int, have: int, length: int, need: int) -> bool:
        return have + min(len(probe) - have, length - at) < need

    ordered = sorted(range(len(members)), key=lambda i: members[i].tobytes())
    inside = np.sort(probe)
    shared = np.zeros(1, dtype=np.int64)  # overlap of the path with the probe, by depth
    path, dead_from, out = np.zeros(0, dtype=np.uint64), None, []
    for i in ordered:
        grams = members[i]
        n = min(len(path), len(grams))
        differ = np.flatnonzero(path[:n] != grams[:n])
        depth = min(int(differ[0]) if len(differ) else n, len(shared) - 1)
        need = least_overlap(len(probe), len(grams), percent)
        if dead_from is not None and depth >= dead_from[0] and too_few(*dead_from, len(grams), need):
            continue
        counts, at, dead = [shared[:depth + 1]], depth, None
        while True:
            have = int(counts[-1][-1])
            if too_few(at, have, len(grams), need):
                dead = (at, have)
                break
            if at == len(grams):
                out.append(i)
                break
            step = grams[at:at + STRIDE]
            found = inside[np.minimum(np.searchsorted(inside, step), len(inside) - 1)] == step
            counts.append(have + np.cumsum(found))
            at += len(step)
        shared, path, dead_from = np.concatenate(counts), grams, dead
    return out


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that link. Members meet their probe in blocks, so no task holds all partners of a set."""
    blocks = pairs.groupBy("a").agg((F.count("*") / TRIE_MEMBERS).cast("int").alias("more"))
    members = (pairs.join(blocks, "a").withColumn("block", F.when(F.col("more") > 0, F.pmod(F.xxhash64("b"), F.col("more") + 1)).otherwise(0).cast("long"))
               .join(sets.withColumnRenamed("node", "b"), "b").select("a", "block", F.lit(1).alias("kind"), "b", "grams"))
    probes = (blocks.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("more").cast("long"))))
              .join(sets.withColumnRenamed("node", "a"), "a").select("a", "block", F.lit(0).alias("kind"), F.col("a").alias("b"), "grams"))
    rows = (members.unionByName(probes).repartition(shuffle_width(pairs.sparkSession), "a", "block")
            .sortWithinPartitions("a", "block", "kind"))

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, probe, names, held = None, None, [], []

        def answer() -> pd.DataFrame:
            return pd.DataFrame({"a": key[0] if key else 0, "b": [names[i] for i in trie_links(probe, held, percent)]}, dtype="int64")

        for batch in batches:
            for a, block, kind, b, grams in batch.itertuples(index=False):
                grams = np.frombuffer(grams, dtype=np.uint64)
                if (a, block) != key or len(held) >= 2 * TRIE_MEMBERS:
                    if held:
                        yield answer()
                    key, names, held = (a, block), [], []
                if kind == 0:
                    probe = grams
                else:
                    names.append(b)
                    held.append(grams)
        if held:
            yield answer()

    return rows.mapInPandas(check, "a long, b long")


# ---- the join


def ngram_components(docs: DataFrame, size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """Documents whose sets of word n-grams have a Jaccard similarity of ``percent`` or more, as components.

    docs: doc_id and text. A document's set has its distinct n-grams of lower-cased
    words; with fewer words than that, the whole sequence is its one n-gram; null, empty
    and blank texts have the empty set, which links with nothing. Returns one row per
    row of ``docs``: doc_id, n_shingles, component_id (the smallest doc_id that links
    reach), n_copies (rows with the same set). A row is a document; rows that repeat an id
    link like any others. Null ids take part and are never the smallest; a component of
    null ids alone has a null id. Other columns are not read; no rows give no rows.

    Every link is decided on the whole sets. Equal sets are one node first. A set is
    routed by its rarest n-grams, as many as a partner can't avoid; then each set is held
    against the one set in which such an n-gram comes earliest, and what remains in
    different components pair by pair. Pairs that signatures rule out need no set.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    id_type = docs.schema["doc_id"].dataType.simpleString()
    sketch = spark.sparkContext.broadcast(frequency_sketch(docs, size))

    def describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for rows, texts in chunks(batch):
                sets = text_sets(texts, size)
                yield pd.DataFrame({"doc_id": rows["doc_id"].array, "n_shingles": [len(s) for s in sets], "node": [set_id(s) for s in sets]})

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sent: set[int] = set()  # of copies in one task the first is routed
        for batch in batches:
            for _, texts in chunks(batch):
                new = {node: s for s in text_sets(texts, size) if (node := set_id(s)) not in sent}
                sent.update(new)
                yield _prefixes(list(new.values()), list(new), sketch.value, percent)

    found = staged(docs.mapInPandas(describe, f"doc_id {id_type}, n_shingles long, node long"), "set_ids")
    classes = staged(found.where(F.col("node") != _NO_SET).groupBy("node").agg(
        F.min("doc_id").alias("doc_id"), F.count("*").alias("n_copies")), "set_classes")

    routed = docs.mapInPandas(route, "gram long, pos int, size int, node long")
    rows = routed.repartition(shuffle_width(spark), "gram").sortWithinPartitions("gram", "pos", "size", "node")
    first = staged(_first_candidates(rows, percent), "candidates")
    pairs = staged(first.where("kind = 0").select("a", "b").distinct(), "pairs")

    member_rows = first.where("kind = 1").select("gram", "a", "pos", "size")
    links = _linked(pairs, docs, classes, sketch, size, percent)
    known = components(links)

    labelled = member_rows.join(known.select(F.col("node").alias("a"), "component"), "a", "left").withColumn(
        "component", F.coalesce("component", "a"))
    others = _other_candidates(staged(labelled, "members"), percent)
    tried = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    others = staged(others.join(tried, ["a", "b"], "left_anti"), "pairs")
    if not others.isEmpty():
        links = links.unionByName(_linked(others, docs, classes, sketch, size, percent))
        known = components(staged(links, "set_links"))

    ids = known.join(classes, "node").select("node", "component", "doc_id")
    smallest = ids.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    linked = ids.join(smallest, "component").select("node", "component_id")
    named = classes.join(linked, "node", "left").select(
        "node", "n_copies", F.coalesce("component_id", "doc_id").alias("component_id"))
    with_set = found.where(F.col("node") != _NO_SET).join(named, "node").select("doc_id", "n_shingles", "component_id", "n_copies")
    without = found.where(F.col("node") == _NO_SET).select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(1).cast("long").alias("n_copies"))
    return with_set.unionByName(without)


def _of_nodes(docs: DataFrame, pairs: DataFrame, classes: DataFrame, size: int,
              describe: Callable[[int, np.ndarray], tuple], schema: str) -> DataFrame:
    """A row, by ``describe``, for each node of the pairs, from the text of one document of each.

    Documents are picked by id and read where they lie; only what is described travels.
    """
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    wanted = staged(nodes.join(classes, "node").select("node", "doc_id"), "wanted")
    likely = likely_in(docs, "doc_id", wanted.select("doc_id"))
    names = T.StructType.fromDDL(schema).names

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for _, texts in chunks(batch):
                yield pd.DataFrame([describe(set_id(s), s) for s in text_sets(texts, size) if len(s)], columns=names)

    # an id that stands on several rows brings several texts, and the filter a few others; of those of a wanted set one stays
    found = likely_in(likely.select("text").mapInPandas(read, schema), "node", wanted.select("node"))
    return found.join(wanted.select("node"), "node", "left_semi").dropDuplicates(["node"])


def _linked(pairs: DataFrame, docs: DataFrame, classes: DataFrame, sketch: Broadcast, size: int, percent: int) -> DataFrame:
    """The pairs that link: signatures rule most others out, tries decide. Frequent n-grams come first, so tries share paths."""
    left = _possible(pairs, docs, classes, size, percent)

    def describe(node: int, grams: np.ndarray) -> tuple:
        return node, in_global_order(grams, sketch.value)[::-1].tobytes()

    sets = staged(_of_nodes(docs, left, classes, size, describe, "node long, grams binary"), "sets")
    return staged(_verified(left, sets, percent), "set_links")


def first_of_each_component(docs: DataFrame, size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """The documents without near copies: of each component the row with the smallest id, all columns as they were.

    Rows without a set and rows without an id all stay. Rows that repeat an id stay or go
    together; of those with the same text one stays.
    """
    found = ngram_components(docs.where("doc_id IS NOT NULL"), size, percent).where("n_shingles > 0")
    found = staged(found.groupBy(F.col("doc_id").alias("__id")).agg(
        F.count_if(F.col("doc_id") == F.col("component_id")).alias("__rows"), F.count("*").alias("__all")), "kept_ids")
    # only documents that go or repeat an id are joined with what was found
    joined, others = split_likely(docs, "doc_id", found.where("__rows = 0 OR __all > 1").select("__id"))
    words = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False)) & F.col("doc_id").isNotNull()
    kept = joined.where(words).join(found.where("__rows > 0"), F.col("doc_id") == F.col("__id"))
    names = [F.col(f"`{c}`") for c in docs.columns]
    repeated = (kept.where("__all > 1").groupBy("__id", F.col("text").alias("__text")).agg(F.min(F.struct(*names)).alias("__row"))
                .select("__row.*"))
    return (kept.where("__all = 1").select(*names).unionByName(repeated).unionByName(joined.where(~words))
            .unionByName(others))
