import numpy as np
import pytest
from helpers import rows, table

from ledgerspark.llm import decontaminate as dc


def local_score(a, b):
    """Smith-Waterman with a full table."""
    h, best, end = np.zeros((len(a) + 1, len(b) + 1), int), 0, 0
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            h[i, j] = max(0, h[i - 1, j - 1] + (dc.MATCH if a[i - 1] == b[j - 1] else dc.MISMATCH), h[i - 1, j] + dc.GAP, h[i, j - 1] + dc.GAP)
            if h[i, j] > best:
                best, end = h[i, j], j
    return best, end


def test_alignment():
    rng = np.random.default_rng(4)
    for _ in range(60):
        a, b = rng.integers(1, 6, size=int(rng.integers(1, 20))), rng.integers(0, 6, size=int(rng.integers(1, 40)))
        assert dc.align(a, b)[0] == local_score(a, b)[0]


def brute(docs, items):
    """Best alignment of every item with every whole document."""
    out = set()
    for key, text in docs:
        words = dc.words_of(text)
        for item, passage in items:
            own = dc.words_of(passage)
            number = {w: i + 1 for i, w in enumerate(own)}
            if own and words:
                best = dc.align(np.array([number[w] for w in own]), np.array([number.get(w, 0) for w in words]))[0]
                if best >= dc.MATCH * min(dc.CUT * len(own), dc.LONG):
                    out.add((key, item))
    return out


def test_given_documents(spark, small):
    docs, items = table(small, "documents")[["doc_id", "text"]].values.tolist(), table(small, "benchmark")[["item_id", "text"]].values.tolist()
    got = rows(dc.op8_decontaminate(spark, small), "doc_id", "item_id", "score", "start", "end", "passage")
    assert {r[:2] for r in got} == brute(docs, items) and len({r[:2] for r in got}) == len(got)
    texts = dict(docs)
    assert all(texts[r[0]][r[3] : r[4]] == r[5] for r in got)


@pytest.fixture(scope="module")
def planted(spark):
    rng = np.random.default_rng(11)
    lexicon = ["".join(rng.choice(list("abcdefghij"), size=int(rng.integers(2, 8)))) for _ in range(4000)]
    text = lambda n: " ".join(rng.choice(lexicon, size=n))
    items = [(i, text(int(rng.integers(20, 60)))) for i in range(30)] + [(90, "two words"), (91, None), (92, ""), (93, "?!")]
    docs, want = [], set()
    for d in range(300):
        body, kind = text(int(rng.integers(50, 400))), d % 6
        if kind < 4:
            i = int(rng.integers(0, 30))
            words = items[i][1].split()
            if kind:  # replaced, dropped or added words
                for at in rng.choice(len(words), size=len(words) // 7, replace=False):
                    words[at] = [None, "changed", "", words[at] + " added"][kind]
            docs.append((d, f"{body} {' '.join(words).upper()}, {text(60)}"))
            want.add((d, i))
        else:
            docs.append((d, body))
    return docs, items, want


def test_edited_copies_are_found(spark, planted, monkeypatch):
    docs, items, want = planted
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as row", "2 as item", "'s' as seeds", "3 as score")
    b = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "4 as item", "5 as rare")
    assert {r[:2] for r in rows(dc.contaminated(d, b), "doc_id", "item_id")} == want == brute(docs, items)
    kept = dc.drop_contaminated(d, b)
    assert kept.columns == d.columns and {r[0] for r in rows(kept, "doc_id")} == {k for k, _ in docs} - {k for k, _ in want}
    monkeypatch.setattr(dc, "SLICE_WORDS", 200)  # several passes
    assert {r[:2] for r in rows(dc.contaminated(d, b), "doc_id", "item_id")} == want


def test_a_passage_in_most_documents(spark):
    """No gram of the item is rare in the corpus; the rarer ones of the item are seeds all the same."""
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"
    docs = [(i, f"w{i} {item} v{i}") for i in range(200)] + [(1000 + i, f"alpha beta gamma delta other words {i}") for i in range(300)]
    got = dc.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(1, item)], "item_id long, text string"))
    assert {r[0] for r in rows(got, "doc_id")} == set(range(200))


def test_odd_rows(spark):
    item = "one two three four five six seven"
    data = [(1, None), (2, ""), (None, item), (3, item), (3, item), (4, "x " * 300_000 + item), (5, "İ " + item), (6, "one two three four")]
    df = spark.createDataFrame(data, "doc_id long, text string")
    b = spark.createDataFrame([(1, item), (1, item), (None, item), (2, "x")], "item_id long, text string")
    got = rows(dc.contaminated(df, b).where("item_id = 1"), "doc_id")
    assert got == sorted([(None,), (3,), (3,), (4,), (5,), (6,)], key=repr)
    assert dc.contaminated(df.limit(0), b).count() == 0 and dc.contaminated(df, b.limit(0)).count() == 0
    assert dc.drop_contaminated(df, b.where("item_id = 1")).count() == 2


def test_an_edited_copy_in_hundreds_of_documents(spark):
    """The grams that survive the edits are the item's most frequent ones in the corpus, because the copy is popular."""
    words = [f"q{i}" for i in range(40)]
    copy = " ".join("other" if i % 5 == 4 else w for i, w in enumerate(words))
    docs, items = [(i, f"a{i} b{i} {copy} c{i}") for i in range(300)] + [(1000 + i, f"d{i} e{i}") for i in range(300)], [(1, " ".join(words))]
    got = dc.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {r[:2] for r in rows(got, "doc_id", "item_id")} == brute(docs, items) == {(i, 1) for i in range(300)}


@pytest.mark.parametrize("edit", ["replaced", "added"])
@pytest.mark.parametrize("every", [1, 2, 3, 4, 5])
def test_edits_of_every_nth_word(spark, edit, every):
    """What whole documents align with is found, down to the last word that the cut needs."""
    rng = np.random.default_rng(every)
    lexicon = [f"w{i}" for i in range(500)]
    items = [(i, " ".join(rng.choice(lexicon, size=n))) for i, n in enumerate([1, 2, 3, 5, 12, 16, 39, 40, 59, 80, 120])]
    docs = []
    for i, text in items:
        words = text.split()
        for first in range(min(every, len(words))):
            for left in (0, 1, 2):  # words cut off at the end
                own = words[: len(words) - left]
                own = [x for k, w in enumerate(own) for x in ([w] if k % every != first else ["changed"] if edit == "replaced" else [w, "added"])]
                docs.append((len(docs), " ".join([*rng.choice(lexicon, size=80), *own, *rng.choice(lexicon, size=20)])))
    got = dc.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    want = brute(docs, [(i, t) for i, t in items])
    assert {r[:2] for r in rows(got, "doc_id", "item_id")} == want


def test_passages_hold_every_alignment_at_the_cut(monkeypatch):
    """Random texts of few words, where many alignments lie just at the cut; hits of long texts in parts."""
    monkeypatch.setattr(dc, "WORDS_AT_ONCE", 16)
    rng = np.random.default_rng(7)
    for kinds in (3, 6, 12, 30):
        lexicon = [f"w{i}" for i in range(kinds)]
        items = [(i, " ".join(rng.choice(lexicon, size=n))) for i, n in enumerate([1, 2, 3, 4, 7, 15, 41, 90])]
        own = dc.Items(items)
        for d in range(60):
            text = " ".join(rng.choice([*lexicon, "other"], size=int(rng.integers(0, 90))))
            got = {(d, i): score for i, score, _, _ in dc.leaks_of(own, own.numbers(text))}
            assert set(got) == brute([(d, text)], items)
