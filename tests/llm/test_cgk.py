from __future__ import annotations

import numpy as np
import pytest

from sluicework.llm import cgk
from sluicework.llm.common import lower_words
from sluicework.llm.queries import QUERIES
from tests.llm.messy import PASSAGE, empty, messy

FOLDER = "/root/testdata/sf0.001"


def distance(a, b):
    """Least edit distance between ``a`` and a beginning of ``b``."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return min(row)


def brute(docs, items, edits=0.1):
    """(doc, item) pairs where the item stands, word for word or with few edits, at some word of the document."""
    found = set()
    for d, text in docs:
        words = [w.decode() for w in lower_words(text or "")]
        for i, item in items:
            own = [w.decode() for w in lower_words(item or "")]
            pattern = " ".join(own)
            most = int(edits * len(pattern))
            for start in range(len(words) if own else 0):
                window = " ".join(words[start : start + len(own) + 3])[: len(pattern) + most]
                if len(set(own) & set(words[start : start + len(own) + 3])) * 2 >= len(set(own)) and distance(pattern, window) <= most:
                    found.add((d, i))
                    break
    return found


def test_query_equals_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    got = QUERIES["op9_decontamination"](spark, FOLDER).collect()
    assert {(r.doc_id, r.item_id) for r in got} == brute(docs, items)
    assert len(got) == len({(r.doc_id, r.item_id) for r in got})


def test_edit_distance_equals_the_table():
    random = np.random.default_rng(2)
    for _ in range(300):
        a = "".join(random.choice(list("abc "), random.integers(1, 40)))
        b = "".join(random.choice(list("abc "), random.integers(0, 40)))
        exact, most = distance(a, b[: len(a) + len(a)]), len(a)
        assert cgk.edit_distance(cgk.Matcher._masks(a), len(a), b, most) == exact


@pytest.mark.parametrize(("share", "least"), [(0.0, 1.0), (0.03, 0.99), (0.06, 0.99), (0.09, 0.97), (0.1, 0.97)])
def test_recall_under_edits(spark, share, least):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    matcher, random = cgk.Matcher(items), np.random.default_rng(4)
    texts = []
    for *_, pattern in matcher.items:
        chars = list(pattern)
        for _ in range(int(share * len(chars))):
            at = int(random.integers(len(chars)))
            [lambda c, p: c.__setitem__(p, "x"), lambda c, p: c.pop(p), lambda c, p: c.insert(p, "q")][int(random.integers(3))](chars, at)
        texts.append("some words before " + "".join(chars) + " and some after it")
    hits = matcher.hits(texts)
    assert np.mean([any(h[0] == i for h in own) for i, own in enumerate(hits)]) >= least


def test_samples_choose_the_candidates(spark):
    """Without them nothing is verified; with them few items are, of those that are not there."""
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    texts = [f"before it {t} after" for _, t in items]
    matcher = cgk.Matcher(items)
    assert all(any(h[0] == i for h in own) for i, own in enumerate(matcher.hits(texts)))
    met = total = 0
    for words, members in matcher.by_words.items():
        length = len(matcher.items[members[0]][2])
        windows = [" ".join(r.text.lower().split())[:length] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").limit(60).collect()]
        met += sum(map(len, matcher._candidates(windows, words)))
        total += len(windows) * len(members)
    assert met < 0.1 * total
    empty_of = cgk.Matcher(items)
    empty_of.tables = {n: (keys[:0], owners[:0]) for n, (keys, owners) in empty_of.tables.items()}
    assert not any(empty_of.hits(texts))


def test_clean_documents_match_nothing(spark):
    items = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    clean = spark.createDataFrame([(i, f"this is a clean document about nothing number {i} and the rest of it") for i in range(50)], "doc_id long, text string")
    assert cgk.contaminated(clean, items).count() == 0


def test_messy_rows(spark):
    items = [(1, PASSAGE.upper()), (2, None), (3, ""), (4, " ,.; "), (None, "héhé 日本語 ñ héhé"), (1, PASSAGE.upper()), (5, "one two"), (6, "x")]
    benchmark = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, doc_id int")
    got = cgk.contaminated(messy(spark), benchmark).collect()
    assert {(r.doc_id, r.item_id, r.distance) for r in got} == {(9, 1, 0), (10, 1, 0), (None, 1, 0), (8, None, 0), (11, 5, 0), (12, 6, 0)}
    docs = messy(spark)
    assert docs.filter(cgk.is_contaminated(docs, benchmark)).count() == len(got)
    assert cgk.contaminated(empty(spark), benchmark).count() == 0
    assert cgk.contaminated(docs, benchmark.filter("false")).count() == 0
    assert docs.filter(cgk.is_contaminated(docs, benchmark.filter("false"))).count() == 0


def test_a_large_benchmark_takes_several_passes(spark, monkeypatch):
    monkeypatch.setattr(cgk, "ITEM_CHARS_A_PASS", 500)
    docs, items = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "benchmark"))
    assert len(list(cgk.passes(items, cgk.Settings()))) > 1
    assert {(r.doc_id, r.item_id) for r in cgk.contaminated(docs, items).collect()} == {
        (r.doc_id, r.item_id) for r in QUERIES["op9_decontamination"](spark, FOLDER).collect()
    }


def test_edits_in_each_third_word_and_up_to_the_bound(spark):
    """No three words in a row are left, and the edits are as many as may be."""
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    matcher, random = cgk.Matcher(items), np.random.default_rng(9)
    texts, within = [], []
    for _, words, pattern in matcher.items:
        texts.append("before it " + " ".join(w.decode() + "z" * (k % 3 == 0) for k, w in enumerate(words)) + " after")
        within.append(-(-len(words) // 3) <= int(0.1 * len(pattern)))
    for _, _, pattern in matcher.items:
        chars = list(pattern)
        for at in random.choice(np.arange(1, len(chars)), int(0.1 * len(chars)), replace=False):
            chars[int(at)] = "q"
        texts.append("before it " + "".join(chars) + " after")
        within.append(True)
    assert any(within[: len(matcher.items)])
    hits = matcher.hits(texts)
    assert all(any(h[0] == i % len(matcher.items) for h in own) for i, own in enumerate(hits) if within[i])


def test_lost_blanks_before_the_first_words_and_scripts_without_blanks():
    item = "a b c d e f g h then comes a long and ordinary line of many words that nobody ever changed at all, not even once in its life"
    run = "日本語の文章には単語の間に空白がないので項目は長い文字列の中に現れることがあります"
    matcher = cgk.Matcher([(1, item), (2, run), (3, "word")])
    hits = matcher.hits(["so: abcdefgh" + item[15:] + " and more", "これは前の文で" + run + "そして続きます", "wordy words", "a word here"])
    assert [[h[0] for h in own] for own in hits] == [[0], [1], [], [2]]
