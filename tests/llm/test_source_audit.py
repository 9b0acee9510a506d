from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from postlens.llm import source_audit
from postlens.llm.source_audit import shares, source_divergence

SCHEMA = "doc_id long, text string, lang string, source string, term string, n string"
TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plainly(rows: list[tuple]) -> set[tuple]:
    docs = [((r[2] or ""), (r[3] or ""), [t.translate(UPPER) for t in TERM.findall(r[1] or "")]) for r in rows]
    out = set()
    for lang in {d[0] for d in docs}:
        held = Counter(t for d in docs if d[0] == lang for t in set(d[2]))
        kept = {t for t, k in held.items() if k >= 3}
        count = defaultdict(Counter)
        for _, source, terms in (d for d in docs if d[0] == lang):
            count[source].update(t for t in terms if t in kept)
        whole = sum(count.values(), Counter())

        def p(c: Counter, t: str) -> int:
            return 1 + 10**9 * (c[t] + 1) // (sum(c.values()) + len(kept))

        for a in count:
            pairs = [(b, sum((p(count[a], t) - p(count[b], t)) ** 2 // p(count[b], t) for t in kept)) for b in count if b != a]
            terms = [(t, (p(count[a], t) - p(whole, t)) ** 2 // p(whole, t)) for t in kept if count[a][t] and p(count[a], t) > p(whole, t)]
            for part, found in (("pair", pairs), ("term", terms)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out |= {(lang, a, part, item, value, k) for k, (item, value) in enumerate(found, 1) if part == "pair" or k <= 200}
    return out


def documents(seed: int = 3) -> list[tuple]:
    rng = random.Random(seed)
    words = [f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(400)] + ["É", "é", "ß", "K", "straße", "数学", "\u0085x"]
    rows = []
    for i in range(240):
        text = "".join(rng.choice([" ", "\n", "1", "-", "_", "\x00", "\x7f", "@", "[", "`", "{"]) + rng.choice(words[: 20 + i]).upper() for _ in range(rng.randrange(60)))
        rows.append((i, text, rng.choice(["en", "en", "de", None, ""]), f"s{min(rng.randrange(12), rng.randrange(12))}" if i % 9 else None, "x", "y"))
    rows += [(None, None, "en", "only null", "x", "y"), (7, "", "fr", "a", "x", "y"), (7, "alone " * 9, "fr", "b", "x", "y"),
             (8, "one", "it", "single", "x", "y")] + [(9, "same same copy", "en", "s0", "x", "y")] * 40
    return rows


@pytest.mark.parametrize("cells,pairs", [(None, None), (50, 6)])
def test_against_plain_counts(spark, rows, monkeypatch, cells, pairs):
    if cells:  # many shards and blocks
        monkeypatch.setattr(source_audit, "CELLS", cells)
        monkeypatch.setattr(source_audit, "PAIRS", pairs)
    found = source_divergence(spark.createDataFrame(documents(), SCHEMA))
    assert found.columns == ["lang", "source", "part", "item", "value", "rank"]
    got = [tuple(r) for r in found.collect()]
    assert len(got) == len(set(got)) and set(got) == plainly(documents())
    assert ("fr", "a", "pair", "b", 0, 1) in got and not any(r[0] == "it" for r in got)


def test_one_very_long_text_and_small_slices(spark, monkeypatch):
    rows = [(1, "ab Cd " * 300_000, "en", "a", "", ""), (2, "ab", "en", "b", "", ""), (3, "ab cd", "en", "b", "", ""), (4, "cd", "en", "a", "", "")]
    assert {tuple(r) for r in source_divergence(spark.createDataFrame(rows, SCHEMA)).collect()} == plainly(rows)


def test_no_rows(spark):
    assert source_divergence(spark.createDataFrame([], SCHEMA)).count() == 0


def test_more_than_200_terms_are_cut_by_value_then_bytes(spark):
    words = [f"a{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(300)]
    rows = [(k, " ".join(words), "en", "a", "", "") for k in range(3)] + [(9, "other", "en", "b", "", "")] * 3
    found = [r for r in source_divergence(spark.createDataFrame(rows, SCHEMA)).collect() if r["part"] == "term" and r["source"] == "a"]
    assert [r["item"] for r in sorted(found, key=lambda r: r["rank"])] == sorted(words)[:200]


def test_shares_are_exact():
    rng = random.Random(1)
    for _ in range(300):
        total, terms = rng.randrange(10 ** rng.randrange(1, 16)), rng.randrange(1, 10 ** rng.randrange(1, 8))
        counts = [rng.randrange(total + 1), 0, total if terms == 1 else total // 2]
        assert shares(np.array(counts), total, terms).tolist() == [1 + 10**9 * (c + 1) // (total + terms) for c in counts]
    with pytest.raises(OverflowError):
        shares(np.array([1]), 2**62, 1)
