"""The filter audit against counting every order by hand."""

from __future__ import annotations

import random
from collections import Counter, defaultdict
from itertools import permutations

import pyarrow as pa
import pytest

import brute
from tidemark.llm import audit


def _mask(text):
    text = text or ""
    words = brute.words(text)
    return (
        (len(words) < 200)
        + 2 * (100 * len(set(words)) < 50 * len(words))
        + 4 * (100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text))
        + 8 * any(c in "#$%&*|" for c in text)
    )


def _expected(rows, labels):
    """rows: (id, text, lang); labels: (id, quality, toxic)."""
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    least = {}
    for i, text, _ in rows:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    out = Counter()
    shapley = Counter()
    parts = {lang or "" for _, _, lang in rows}
    for i, text, lang in rows:
        mask = _mask(text) + 16 * (i is not None and i > least[text or ""])
        for order in map("".join, permutations("ABCDE")):
            gone = False
            for step, c in enumerate(order, 1):
                fails, key = bool(mask & 1 << "ABCDE".index(c)), (lang or "", order, step)
                out[*key, "kept"] += not gone and not fails
                out[*key, "removed"] += fails and not gone
                out[*key, "redundant"] += fails and gone
                out[*key, "unique"] += mask == 1 << "ABCDE".index(c)
                out[*key, "good"] += fails and not gone and i in good
                out[*key, "toxic"] += fails and not gone and i in toxic
                shapley[lang or "", c] += fails and not gone
                gone |= fails
    whole = []
    for part in parts:
        for order in map("".join, permutations("ABCDE")):
            for step in range(1, 6):
                own = [out[part, order, step, x] for x in ("kept", "removed", "redundant", "unique", "good", "toxic")]
                whole.append((part, order, step, *own, shapley[part, order[step - 1]]))
    return sorted(whole)


def _rows(n=300):
    rnd = random.Random(5)
    texts = [t for _, t in brute.texts()] + ["A" * 5 + " b" * 300, "wörter " * 250, "x # y " * 120, brute.prose(50, 400), brute.prose(51, 199), brute.prose(52, 200)]
    rows = [(k, rnd.choice(texts), rnd.choice(["en", "de", None, ""])) for k in range(n)]
    rows += [(None, texts[0], "en"), (None, texts[0], "fr"), (7, texts[0], "en"), (7, texts[0], "en"), (0, texts[0], "en"), (0, texts[0], "de")]
    rnd.shuffle(rows)
    labels = [(k, rnd.choice([0, 1, None]), rnd.choice([0, 1, None])) for k in range(-5, n, 2)]
    return rows, [*labels, (7, 0, 1), (7, 1, 0), (None, 1, 1)]


def _frames(spark, rows, labels):
    docs = spark.createDataFrame(
        [(i, t, lang, "a", "b", "c", "d", 3) for i, t, lang in rows],
        "doc_id long, text string, lang string, part string, digest string, mask string, id string, n int",
    )
    said = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").selectExpr("*", "1 as n", "'x' as part")
    return docs.repartition(5), said


def test_against_counting(spark):
    rows, labels = _rows()
    got = sorted(tuple(r) for r in audit.interactions(*_frames(spark, rows, labels)).collect())
    assert got == _expected(rows, labels)


def test_hot_group_of_copies(spark):
    """A third of all rows are one text: it reaches the last counts as a few rows."""
    rows = [(k, "same text" if k % 3 == 0 else f"text {k}", "en") for k in range(900)]
    docs, labels = _frames(spark, rows, [(0, 1, 1), (3, 1, 0)])
    counts = audit.counted(audit.flagged(docs), labels).collect()
    assert len(counts) <= 6 and sum(r.n for r in counts) == 900
    assert sum(r.n for r in counts if r["mask"] >= 16) == 299
    assert sorted(tuple(r) for r in audit.audit(audit.counted(audit.flagged(docs), labels)).collect()) == _expected(rows, [(0, 1, 1), (3, 1, 0)])


def test_empty(spark):
    docs, labels = _frames(spark, [], [])
    assert audit.interactions(docs, labels).collect() == []
    docs, labels = _frames(spark, [(1, None, None)], [])
    got = audit.interactions(docs, labels).collect()
    assert len(got) == 600 and {r.part for r in got} == {""}


def test_fields_do_not_run_over():
    """Counts far above 32 bits stay apart in the packed sum; too many documents are refused."""
    counters = audit.Counters()
    n = (1 << 62) - 3
    kept, removed, redundant, unique = counters.total([(0, n), (1, 5), (31, n)])
    assert kept[0, 0] == n and removed[0, 0] == n + 5 and redundant[0, 1] == n and unique[0, 0] == 5
    assert sum(kept.ravel().tolist()) == 600 * n + 5 * sum(o.index("A") for o in counters.orders)
    with pytest.raises(OverflowError):
        counters.total([(0, 1 << 62), (3, 1 << 62)])


def test_every_step_accounts_for_every_document():
    """In each order what a filter fails is removed or redundant, and what is left at the end passed all."""
    counters, counts = audit.Counters(), [(m, 3 * m + 1) for m in range(32)]
    kept, removed, redundant, _ = counters.total(counts)
    failing = [sum(n for m, n in counts if m >> k & 1) for k in range(5)]
    for o, order in enumerate(counters.orders):
        assert kept[o, 4] == 1
        assert kept[o, 4] + removed[o].sum() == sum(n for _, n in counts)
        for s, c in enumerate(order):
            assert removed[o, s] + redundant[o, s] == failing["ABCDE".index(c)]


def test_words_are_those_of_the_contract():
    odd = ["a\x1cb\x85c d", "a\tb\nc\x0bd\x0ce\rf", "   ", ""]
    masks, _ = audit.text_masks(pa.array([x * 60 for x in odd]))
    assert masks.tolist() == [_mask(x * 60) for x in odd]


def test_general_filters(spark):
    """Three filters of one's own: 6 orders of 3 steps."""
    counts = spark.createDataFrame([("p", 1, True, False, 4), ("p", 6, False, True, 3), ("q", 0, False, False, 2)], "part string, mask int, good boolean, toxic boolean, n long")
    got = defaultdict(dict)
    for r in audit.audit(counts, "XYZ").collect():
        got[r.part][r.filter_order, r.step] = r
    assert len(got["p"]) == 18 and len(got["q"]) == 18
    assert (got["p"]["XYZ", 2].removed, got["p"]["XYZ", 3].redundant, got["p"]["ZYX", 1].removed) == (3, 3, 3)
    assert got["p"]["XYZ", 1].good_lost == 4 and got["p"]["YXZ", 1].toxic_lost == 3 and got["p"]["XYZ", 2].shapley == 9
