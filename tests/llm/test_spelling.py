import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from quarrylog.llm import skew, spelling

SF = "/root/testdata/sf0.001"


def counts(rows):
    """The contract's words, run by run."""
    out = Counter()
    for name, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            low = "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in run)
            h = zlib.crc32(f"{'' if name is None else name}:{low}".encode())
            if h % 97 == 0:
                low = low[: h % len(low)] + low[h % len(low) + 1 :]
            out[low] += 1
    return {w: n for w, n in out.items() if n >= 3 and len(w) >= 5}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def grouped(words):
    """All pairs by brute force, over words of nearly the same length."""
    by_size, near = defaultdict(list), defaultdict(list)
    for w in words:
        by_size[len(w)].append(w)
    for w in words:
        near[w] = [v for d in (-1, 0, 1) for v in by_size[len(w) + d] if one_edit(w, v)]
    form = {w: min(near[w], key=lambda v: (-words[v], v), default=None) for w in words}
    form = {w: v if v is not None and words[v] >= 2 * words[w] else None for w, v in form.items()}
    out = {}
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (words[w], len(near[w]), form[w], words[form[w]] if form[w] else None, root)
    return out


def rows_of(df):
    return {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in df.collect()}


def run(spark, tmp_path, rows, schema="doc_id long, text string"):
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "documents.parquet"))
    found = spelling.op12_spelling_variants(spark, str(tmp_path)).collect()
    assert len({r.word for r in found}) == len(found)
    return {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in found}


def few_letters(seed, n, letters="abé", sizes=(5, 9)):
    rng = random.Random(seed)
    return list({"".join(rng.choice(letters) for _ in range(rng.randrange(*sizes))) for _ in range(n)})


@pytest.mark.parametrize("seed, letters", [(1, "ab"), (2, "abc"), (3, "aÀÿz")])
def test_dense_words(spark, seed, letters):
    rng = random.Random(seed)
    words = {w: rng.choice([3, 4, 7, 15, 40, 100, 3000]) for w in few_letters(seed, 300, letters)}
    assert rows_of(spelling.variants(spark.createDataFrame(list(words.items()), "word string, n long"))) == grouped(words)


def test_hot_prefixes(spark, monkeypatch):
    """Half of all words share a long prefix, and no node counts as hot, or all do."""
    words = {w: 3 + i % 11 for i, w in enumerate({"prefix" * 5 + w for w in few_letters(4, 150)} | set(few_letters(5, 150)))}
    want = grouped(words)
    for hot in (0.0, 1.0):
        monkeypatch.setattr(skew, "HOT", hot)
        assert rows_of(spelling.variants(spark.createDataFrame(list(words.items()), "word string, n long"))) == want


def test_texts(spark, tmp_path):
    rng = random.Random(6)
    words = few_letters(7, 60) + ["Straße", "ÉCOLE", "naïve", "naive", "écoles", "x" * 70, "x" * 71]
    rows = [(k, " ".join(rng.choice(words) for _ in range(80)) + "1über,über2 Über") for k in range(60)]
    rows += [(None, "naive " * 9), (7, None), (8, ""), (9, "naive naïve"), (9, "naive naïve"), (10, "ab " * 400_000 + "naïve" * 3), (11, "x" * 300_000), (12, "x" * 300_000 + " " + "x" * 299_999), (13, "x" * 300_000 + " " + "x" * 299_999 + " " + "x" * 299_999)]
    got = run(spark, tmp_path, [(*r, 1, "w") for r in rows], "doc_id long, text string, n int, word string")
    assert got == grouped(counts(rows))


def test_portions_change_nothing(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(spelling, "HELD", 7)
    monkeypatch.setattr(spelling, "AT_ONCE", 50)
    rows = [(k, " ".join(few_letters(k % 5, 40))) for k in range(30)]
    assert run(spark, tmp_path, rows) == grouped(counts(rows))


def test_no_rows(spark, tmp_path):
    assert run(spark, tmp_path, []) == {}


def test_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert rows_of(spelling.op12_spelling_variants(spark, SF)) == grouped(counts(rows))
