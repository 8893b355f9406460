import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarrylog.llm import bpe, common, decontaminate, license_scan, media, ngram_join, pii, registry, secret_scan, shingles, token_ids, toxicity, url_filter, words

SF = "/root/testdata/sf0.001"
LONG = "very long text with many words . " * 3000
DOCS = [(1, "plain words here", 7), (2, None, 7), (3, "", 7), (None, "plain words here", 7), (1, "plain words here", 7), (4, LONG, 7)]


@pytest.fixture()
def docs(spark):
    return spark.createDataFrame(DOCS, "doc_id long, text string, _rid int")


@pytest.fixture()
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string")


def run(spark, tmp_path, f, rows, schema="doc_id long, text string"):
    spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(str(tmp_path / "documents.parquet"))
    return f(spark, str(tmp_path)).toPandas()


# --- 1: personal data
PII = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(d):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def valid(kind, m):
    d = re.sub("[^0-9]", "", m)
    return {"email": True, "ip": kind != "ip" or all(int(x) <= 255 for x in m.split(".")), "card": 16 <= len(d) <= 19 and luhn(d), "phone": 8 <= len(d) <= 15}[kind]


def test_pii_base_spans_match_brute_force(spark, tmp_path):
    rng = random.Random(3)
    rows = [(i, "".join(rng.choice("a1é@. +-()0923x") for _ in range(rng.randrange(200)))) for i in range(300)]
    rows += [(900, "und.34@mail7.example.com_d@e.f 1.2.3.4.5.6.7.8 é 4736962573099581 +1 (487) 555-7209"), (901, None), (902, ""), (903, "9" * 200_000), (904, "a" * 200_000), (None, "a@b.c")]
    got = run(spark, tmp_path, pii.op1_personal_data, rows)
    assert len(got) == len(rows)
    want = {i: ",".join(f"{k}:{m.start()}:{m.end()}" for k, p in PII.items() for m in re.finditer(p, t or "") if valid(k, m[0])) for i, t in rows if i is not None and i < 903}
    for r in got.itertuples():
        if r.doc_id in want:
            assert r.base_sha256 == hashlib.sha256(want[r.doc_id].encode()).hexdigest()
            assert set(filter(None, want[r.doc_id].split(","))) <= set(r.spans.split(","))


def test_pii_contexts_discover_identifiers(spark, tmp_path):
    rows = [(i, f"lorem ipsum contact-mail: user{i}@example.com and so on") for i in range(30)] + [(99, "please see contact-mail: user77(at)example-com today"), (98, "number 5 of 12")]
    got = run(spark, tmp_path, pii.op1_personal_data, rows).set_index("doc_id")
    assert got.spans[99] == "email:25:46" and got.n_email[99] == 0
    assert got.spans[98] == ""


def test_pii_contexts_take_whatever_follows(spark, tmp_path):
    """Tokens without a digit or @, short ones, ones at a text's start, and contexts learnt from found ones."""
    rows = [(i, f"lorem contact-mail: user{i}@example.com and so on") for i in range(60)]
    rows += [(100 + i, f"write to contact-mail: {w}(at)example-com or x") for i, w in enumerate(("ann", "bob", "cyd", "dan", "eve", "fay"))]
    rows += [(200 + i, f"reach-me: {w}(at)example-com today") for i, w in enumerate(("ann", "bob", "cyd", "dan", "eve", "fay", "gus"))]
    rows += [(300, "ann(at)example-com wrote"), (301, "contact-mail: zoe"), (302, "see contact-mail: and then"), (303, None), (304, "")]
    got = run(spark, tmp_path, pii.op1_personal_data, rows).set_index("doc_id").spans
    for i in range(6):
        assert got[100 + i] == "email:23:41" and got[200 + i] == "email:10:28"
    assert got[206] == "email:10:28"  # gus stands only behind what the others taught, in a second round
    assert got[300] == "email:0:18" and got[301] == "email:14:17"
    assert got[302] == got[303] == got[304] == ""  # `and` stands behind a context in one of many texts


def brute_discovery(texts, min_support=5, min_confidence=0.5, min_score=0.8, min_share=0.5):
    """The same scores over dictionaries, for e-mail addresses only."""
    core = lambda m: re.sub(r"(?<![^A-Za-z0-9])[^A-Za-z0-9]+$", "", re.sub("^[^A-Za-z0-9+]+", "", m)) or m
    uses, places, seeds = {}, {}, set()
    for t in set(texts):
        words = re.split(r"[ \t\n]+", t)
        for a, b in zip(["", *words], words):
            if b:
                uses.setdefault(a.lower(), set()).add(core(b))
                places.setdefault(core(b), {}).setdefault(a.lower(), set()).add(t)
                if re.search(PII["email"], b) and a:
                    seeds.add((a.lower(), core(b)))
    known = {w for _, w in seeds}
    behind = lambda ws: {(a, w) for w in ws for a in places[w] if a}
    edges, found = set(seeds), set()
    while True:
        ready = {a for a in {a for a, _ in edges} if len({w for b, w in edges if b == a}) >= min_support}
        conf = {a: min(0.999, len(uses[a] & known) / len(uses[a])) for a in ready}
        conf = {a: c for a, c in conf.items() if c >= min_confidence and len(uses[a] & known) >= min_support}
        fresh = set()
        for w in {w for a in conf for w in uses[a]} - known:
            score = 1 - np.prod([1 - c for a, c in conf.items() if w in uses[a]])
            total = sum(map(len, places[w].values()))
            if score >= min_score and sum(len(places[w].get(a, ())) for a in conf) / total >= min_share:
                fresh.add(w)
        if not fresh:
            return found
        found |= fresh
        known |= fresh
        edges |= behind(fresh)


def test_pii_discovery_matches_brute_force(spark, tmp_path):
    rng = random.Random(5)
    lefts, plain = ["mail:", "mail:", "cc", "(from", "see"], ["x", "7", "and.", "Lorem", "b-2"]
    ids = [f"u{i}@example.com" for i in range(40)] + [f"{w}(at)home" for w in ("ann", "bob", "cyd", "dan", "eve", "fay", "gus", "hal")]
    texts = []
    for _ in range(300):
        left = rng.choice(lefts)
        texts.append(" ".join([rng.choice(plain), left, rng.choice(ids if left == "mail:" or left == "cc" and rng.random() < 0.98 or rng.random() < 0.2 else plain), rng.choice(plain)]))
    texts += ["ann(at)home x", "mail: sys7", "then mail: sys7"]
    rows = list(enumerate(texts + texts[:20]))
    got = run(spark, tmp_path, pii.op1_personal_data, rows)
    found = set()
    for r in got.itertuples():
        text = rows[r.doc_id][1]
        found |= {text[int(s) : int(e)] for _, s, e in (x.split(":") for x in r.spans.split(",") if x)} - {m[0] for m in re.finditer(PII["email"], text)}
    assert found == brute_discovery(texts) and len(found) > 5


def test_pii_copies_change_no_spans(spark, tmp_path):
    rows = [(i, f"lorem ipsum contact-mail: user{i}@example.com and so on") for i in range(30)] + [(99, "please see contact-mail: user77(at)example-com today")]
    rows += [(i + 1000 * k, t) for i, t in rows for k in (1, 2)] + [(5000 + i, rows[0][1]) for i in range(100)]
    got = run(spark, tmp_path, pii.op1_personal_data, rows).set_index("doc_id")
    assert got.spans[99] == got.spans[1099] == got.spans[2099] == "email:25:46"


def test_pii_common_words_leave_few_rows(spark, tmp_path, monkeypatch):
    """Behind `the` stand seven known instances and 2,000 other tokens: no pattern, and no reason to write them all out."""
    tables, keep = [], pii.written
    monkeypatch.setattr(pii, "written", lambda df, name: tables.append((name, keep(df, name))) or tables[-1][1])
    rows = [(i, f"of the w{''.join(chr(97 + int(c)) for c in str(i))} x") for i in range(2000)] + [(3000 + i, f"by the user{i}@example.com x") for i in range(7)]
    rows += [(4000 + i, f"contact-mail: user{i}@example.com x") for i in range(20)] + [(5000, "contact-mail: ann(at)example-com x")]
    got = run(spark, tmp_path, pii.op1_personal_data, rows).set_index("doc_id").spans
    behind = lambda name, left: sum(t.where(pii.F.col("left") == left).count() for n, t in tables if n == name)
    assert got[5000] == "email:14:32" and got[0] == "" and got[3000] == "email:7:24"
    assert behind("pii-edges", "contact-mail:") == 21 and behind("pii-edges", "the") == 0 and behind("pii-bounds", "the") == 8


# --- 2: Simple-8b
def test_simple8b_round_trip():
    rng = np.random.default_rng(1)
    for n in (0, 1, 5, 119, 120, 4000):
        for high in (1, 2, 60, 50_257, 2**33, 2**63):
            x = rng.integers(0, high, n, dtype=np.uint64)
            x[rng.random(n) < 0.3] = 0
            w, marks, raw = token_ids.pack(x)
            assert (token_ids.unpack(w, raw, np.uint64) == x).all()
            if len(marks) > 1:
                assert (token_ids.unpack(w[token_ids.MARK :], raw, np.uint64) == x[marks[1] :]).all()


def test_ranges_by_marks():
    rng = np.random.default_rng(2)
    x = rng.integers(0, 50_257, 9000, dtype=np.uint32)
    w, marks, raw = token_ids.pack(x)
    for a, b in ((0, 9000), (0, 1), (8999, 9000), (767, 1025), (4000, 4000), *np.sort(rng.integers(0, 9001, (30, 2)), axis=1).tolist()):
        assert (token_ids.unpack_range(w, marks, raw, a, b) == x[a:b]).all()


def test_token_files_of_odd_rows(spark, tmp_path, docs, empty):
    for d in (docs, empty):
        path = str(tmp_path / str(d.count()))
        token_ids.write_ids(d, path)
        got = token_ids.read_ids(spark, path).orderBy("start").collect()
        assert len(got) == d.count() and [r.start for r in got] == [sum(x.n_tokens for x in got[:i]) for i in range(len(got))]
        if got:
            assert got[0].doc_id is None and [r.doc_id for r in got[1:]] == sorted(r.doc_id for r in got[1:])


def test_token_files_hold_the_librarys_ids(spark, tmp_path):
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(token_ids.default_tokenizer())
    rows = [(5, "b  c"), (3, None), (9, "<|endoftext|> x"), (1, "Hello, world.\nNew"), (4, "日本 é"), (7, LONG)]
    got = run(spark, tmp_path, token_ids.op2_token_ids, rows).set_index("doc_id")
    start = 0
    for i, t in sorted(rows):
        ids = [*lib.encode(t or "", add_special_tokens=False).ids, 2]
        assert tuple(got.loc[i, ["start", "n_tokens", "ids_crc32"]]) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_piece_tables_agree_with_the_library():
    from tokenizers import Tokenizer

    rng = random.Random(5)
    texts = ["".join(rng.choice(["a", "B", " ", " ", ".", ",", "\n", "é", "'s", "_", "12", "***", "\t", "ß", "İ", "日"]) for _ in range(rng.randrange(60))) for _ in range(2000)]
    for kind, path in ((words.ByteLevelPieces, token_ids.default_tokenizer()), (words.LowerWordPieces, bpe.default_tokenizer())):
        lib = Tokenizer.from_file(path)
        for t, got in zip(texts, kind(path).encode(texts), strict=True):
            assert got == np.array(lib.encode(t, add_special_tokens=False).ids, "<u4").tobytes(), t


# --- 3: licences
def test_licences(spark):
    rows = [(1, "x\nReleased under the MIT License."), (2, "Licensed under CC BY-NC 4.0."), (3, "We licensed nothing under any terms"), (4, license_scan.TEMPLATES[3][1] + " tail"), (5, None), (6, "words " * 3000 + "This work is licensed under the GNU General Public License, version 3. " + "more " * 3000)]
    got = {(r.doc_id, r.license) for r in license_scan.find_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {(1, "mit"), (2, "cc-by-nc-4.0"), (4, "mit"), (6, "gpl-3.0")}


def test_short_notices_match_brute_force(spark):
    rng = random.Random(5)
    vocabulary = ["all", "rights", "reserved", "All", "SPDX-License-Identifier:", "MIT", "Apache-2.0", "license", "the", "of", "(c)"]
    rows = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(12)))) for i in range(300)] + [(900, None), (901, ""), (902, "word " * 20000 + "All rights reserved. " + "word " * 20000), (903, "overall rights reserved"), (None, "All Rights Reserved"), (None, "All Rights Reserved")]
    short = [(n, t) for n, t in license_scan.TEMPLATES if len(license_scan._words(t)) < license_scan.SHINGLE]
    expected = sorted((str(d), n, license_scan.TEMPLATES.index((n, t))) for d, text in rows for n, t in short if f" {' '.join(license_scan._words(t))} " in f" {' '.join(license_scan._words(text or ''))} ")
    found = license_scan.find_licenses(spark.createDataFrame([(d, t, 1, 2) for d, t in rows], "doc_id long, text string, rid int, words int")).collect()
    assert sorted((str(r.doc_id), r.license, r.template) for r in found) == expected
    assert len({x[1] for x in expected}) == 3


# --- 4: benchmark
def test_reparameterised_questions(spark):
    q = "If Alice has 12 apples and Bob gives her 30 km of rope then how much does Alice have in total after the trip of 5 days?"
    rows = [(1, q), (2, "Say, " + q.replace("Alice", "Clara").replace("12", "77")), (3, "Say, " + q.replace("Alice", "Clara", 1).replace("does Alice", "does Eve")), (4, None), (5, ""), (1, q)]
    items = spark.createDataFrame([(9, q), (8, "short one here"), (7, None)], "item_id long, text string")
    got = sorted((r.doc_id, r.item_id, r.slots_changed) for r in decontaminate.contaminated(spark.createDataFrame(rows, "doc_id long, text string"), items).collect())
    # Row 3 changes one Alice of two: no substitution, but most windows are the item's word for word.
    assert got == [(1, 9, False), (1, 9, False), (2, 9, True), (3, 9, False)]
    assert decontaminate.contaminated(spark.createDataFrame(rows, "doc_id long, text string"), items.limit(0)).count() == 0


def test_windows_without_slots_count_beside_a_changed_name(spark):
    q = "so Alice walked home and " + "then she told the whole long story of the river and the stone bridge to all the people of the quiet town again and again " + "until Alice slept"
    rows = [(1, q.replace("until Alice", "until Alicia")), (2, q), (3, "so Alice walked home and nobody knew until Alicia slept")]
    items = spark.createDataFrame([(9, q)], "item_id long, text string")
    got = sorted((r.doc_id, r.slots_changed) for r in decontaminate.contaminated(spark.createDataFrame(rows, "doc_id long, text string"), items).collect())
    assert got == [(1, False), (2, False)]


def test_verbatim_windows_count_beside_an_inconsistent_slot(spark):
    places = ("mill", "bridge", "church", "harbour", "market", "orchard")
    q = "so Alice took " + "".join(f"long walks past the {p} where nobody had seen the {p} keeper with Alice and " for p in places) + "slept"
    rows = [(1, q), (2, q.replace("Alice", "Alicia", 1)), (3, q.replace("Alice", "Clara"))]
    items = spark.createDataFrame([(9, q)], "item_id long, text string")
    got = {r.doc_id: (r.matched, r.n_windows, r.slots_changed) for r in decontaminate.contaminated(spark.createDataFrame(rows, "doc_id long, text string"), items).collect()}
    n = got[1][1]
    # The changed name is the second word: two windows hold it.
    assert got == {1: (n, n, False), 2: (n - 2, n, False), 3: (n, n, True)}


def brute_tokens(text):
    import regex

    out, number = [], None
    for m in regex.finditer(r"\p{L}+|[0-9]+(?:[.,][0-9]+)*", text):
        t = m[0]
        before = text[max(0, m.start() - 2) : m.start()]
        if t[0].isdigit():
            kind, number = "0", m.end()
        elif regex.fullmatch(r"[\p{Ll},;] ", before) and regex.match(r"\p{Lu}\p{Ll}", t):
            kind = "name"
        elif number is not None and text[number : m.start()] in ("", " ") and re.fullmatch(decontaminate.UNITS, t.lower()):
            kind = "unit"
        else:
            kind = None
        out.append((t.lower(), kind or t.lower(), kind is not None))
    return out


def brute_leaks(text, item, width):
    own, other = brute_tokens(item), brute_tokens(text)
    w = min(width, len(own))
    alignments = {}
    for i in range(len(own) - w + 1):
        for j in range(len(other) - w + 1):
            a, b = own[i : i + w], other[j : j + w]
            same = [x[0] for x in a] == [x[0] for x in b]
            bare = sum(not x[2] for x in a) < min(decontaminate.LITERALS, w)
            if w and [x[1] for x in a] == [x[1] for x in b] and (same or not bare):
                alignments.setdefault(j - i, []).append((i, same, {(x[0], y[0]) for x, y in zip(a, b, strict=True) if x[2]}))
    places, changed = set(), False
    for windows in alignments.values():
        pairs = set().union(*(p for _, _, p in windows))
        fits = len(pairs) == len({a for a, _ in pairs}) == len({b for _, b in pairs})
        places |= {i for i, same, _ in windows if fits or same}
        changed |= fits and any(a != b for a, b in pairs)
    n = len(own) - w + 1
    return (len(places), n, changed) if places and (len(places) >= -(-n // 4) or len(places) >= 6) else None


def test_decontamination_matches_brute_force(spark):
    rng = random.Random(11)
    vocabulary = ["river", "stone", "walks", "gives", "then", "and", "of", "the", "Alice", "Bob", "Clara", "12", "5 km", "7.5 kg", "3", "old"]
    sentence = lambda n: "so " + " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [sentence(rng.choice([1, 3, 9, 20, 40])) for _ in range(25)]
    rows = []
    for i in range(150):
        item = rng.choice(items)
        for a, b in (("Alice", "Dora"), ("Bob", "Clara"), ("12", "99"), ("5 km", "8 m"), ("river", "lake")):
            if rng.random() < 0.3:
                item = item.replace(a, b, rng.choice([1, -1]))
        rows.append((i, rng.choice(["", sentence(5) + ", "]) + item + rng.choice(["", " " + sentence(8), " " + rng.choice(items)])))
    rows += [(200, None), (201, ""), (202, items[0])]
    expected = {(d, i): x for d, t in rows for i, q in enumerate(items) if (x := brute_leaks(t or "", q, 8))}
    docs = spark.createDataFrame([(d, t, 1, 2) for d, t in rows], "doc_id long, text string, k1 int, width int")
    got = {(r.doc_id, r.item_id): (r.matched, r.n_windows, r.slots_changed) for r in decontaminate.contaminated(docs, spark.createDataFrame(list(enumerate(items)), "item_id long, text string")).collect()}
    assert got == expected
    assert any(x[2] for x in expected.values()) and len({x[1] for x in expected.values()}) > 3
    kept = decontaminate.drop_contaminated(docs, spark.createDataFrame(list(enumerate(items)), "item_id long, text string"))
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {d for d, _ in rows} - {d for d, _ in expected}
    assert decontaminate.contaminated(docs.limit(0), spark.createDataFrame(list(enumerate(items)), "item_id long, text string")).count() == 0


def test_tokens_and_slots_keep_step(spark):
    texts = ["In \u0130stanbul, Ay\u015fe ran 5 km and \u0130pek 12", "a\u0001b \u0002 c 3\u0001km", "The Ohm \u2126 and \u212a, Stra\u00dfe 1.5 kg", "", "X, Y, Z", "\u03a3\u0399\u03a3\u03a5\u03a6\u039f\u03a3 12,5 percent"]
    d = spark.createDataFrame([(t,) for t in texts], "text string").select(decontaminate.tokens_of(F.col("text")).alias("raw"), decontaminate.canonical(F.col("text")).alias("slots"))
    assert all(len(r.raw) == len(r.slots) for r in d.collect())


def test_two_fillers_of_an_item_stay_two(spark):
    q = "when Alice met Carla near the old bridge then Alice gave Carla her green umbrella and Carla thanked Alice for it"
    rows = [(1, q.replace("Alice", "Doris").replace("Carla", "Erika")), (2, q.replace("Alice", "Doris").replace("Carla", "Doris")), (3, q)]
    items = spark.createDataFrame([(9, q)], "item_id long, text string")
    got = sorted((r.doc_id, r.slots_changed) for r in decontaminate.contaminated(spark.createDataFrame(rows, "doc_id long, text string"), items).collect())
    assert got == [(1, True), (3, False)]


def test_windows_of_numbers_count_as_they_stand(spark):
    q = "add 3 4 5 6 7 8 9 10 11 12 13 14 and say the sum"
    rows = [(1, q), (2, "add 21 22 23 24 25 26 27 28 29 30 31 32 or 33"), (3, None), (4, "add 1 2 3 4 5 6 7 8 9 10 11 12 or 13")]
    items = spark.createDataFrame([(9, q)], "item_id long, text string")
    # Row 4 has three of the item's ten windows word for word.
    assert sorted(r.doc_id for r in decontaminate.contaminated(spark.createDataFrame(rows, "doc_id long, text string"), items).collect()) == [1, 4]


# --- 5: urls
def brute_url(url):
    if url is None or "://" not in url:
        return "", "", None, "allow"
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), h + p, v) for v, h, p in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, max(fits)[1], max(fits)[2]) if fits else (host, path, None, "allow")


def test_url_rules(spark, tmp_path):
    urls = ["http://a.example.net/en/1", "https://EXAMPLE.net/de/?x=/en/", "http://net/", "http://net", "x://a.org/fr/", "http://aorg/fr/", None, "", "no scheme", "http://b.example.com/de/x#y", "a://b://c.net/", "http://example.net?/en/", "http://." + "a." * 500 + "net/x", "http://a.example.net/en/1"]
    spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string").write.parquet(str(tmp_path / "pages.parquet"))
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.op5_url_filter(spark, str(tmp_path)).collect()}
    assert got == {i: brute_url(u) for i, u in enumerate(urls)}


# --- 6: toxicity
def test_toxicity_generalises(spark):
    rng = random.Random(2)
    plain = ["the", "river", "stone", "moves", "over", "green", "hills", "and", "into", "town", "today"]
    texts, labels = [], []
    for i in range(400):
        t = [rng.choice(plain) + rng.choice(["", "s", "ing"]) for _ in range(30)]
        if i % 5 == 0:
            t[rng.randrange(30)] = rng.choice(["grumblox", "snarvik"]) + rng.choice(["", "er", "ish"])
        texts.append(" ".join(t))
        labels.append(int(i % 5 == 0))
    model = toxicity.fit(texts, labels)
    pool = toxicity.Pooler(model)
    base = " ".join(plain)
    low, plain_hit, dashed, null = model.scores(pool.pool([base, base + " grumblox", base + " g-r-u-m-b-l-o-x", None]))
    assert low < 0.3 and null < 0.3 and plain_hit > 0.5 and dashed > 0.5
    assert toxicity.fit(["a b"], [0]) is None


def test_toxicity_on_held_out_rows(spark):
    got = toxicity.op6_toxicity(spark, "/root/testdata/sf0.01").toPandas()
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").toPandas().merge(got, on="doc_id")
    held = labels[labels.held_out]
    assert set(got.held_out) == {True, False} and got.score.between(0, 1).all()
    assert (held.predicted == held.toxic).mean() > 0.9
    assert (held.toxic[held.predicted == 1] == 1).mean() > 0.9


# --- 7: secrets
@pytest.fixture(scope="module")
def table(spark):
    return secret_scan.fit(spark.read.parquet(f"{SF}/documents.parquet"))


SECRETS = {"assign": (r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A), "access": (r"AKIA[A-Z0-9]+", 0), "hex": (r"[0-9a-f]+", 0)}


def test_secret_base_spans_match_brute_force(spark, tmp_path):
    rng = random.Random(4)
    parts = ["token", "=", " ", '"', "AKIA", "abcdef0123456789", "PASSWD", ":", "xyzzy9", "é", "ABCD1234", "api_key", "x"]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randrange(40)))) for i in range(300)] + [(900, None), (901, ""), (902, "a" * 100_000), (903, "token=short1 secret:'abc' Api_Key = 0123456")]
    got = run(spark, tmp_path, secret_scan.op7_secrets, rows)
    texts = dict(rows)
    least = {"assign": lambda m: len(m[2]) >= 6, "access": lambda m: len(m[0]) >= 20, "hex": lambda m: len(m[0]) >= 24}
    for r in got.itertuples():
        found = sorted((m.start(), i, f"{k}:{m.start()}:{m.end()}") for i, (k, (p, f)) in enumerate(SECRETS.items()) for m in re.finditer(p, texts[r.doc_id] or "", f) if least[k](m))
        want = ",".join(x[2] for x in found)
        assert r.base_sha256 == hashlib.sha256(want.encode()).hexdigest(), texts[r.doc_id]
        assert set(filter(None, want.split(","))) <= set(r.spans.split(","))


def test_random_strings_and_redaction(spark, table):
    rows = [(1, "my key is ghp_aB3dE5fG7hI9jK1lM3nO5pQ7rS9tU1vW3xY5 ok", 5), (2, "see convertTimestampToMillis2_default_settings_v2", 5), (3, None, 5), (4, "", 5), (5, 'é token = "abcdef99" end', 5)]
    d = spark.createDataFrame(rows, "doc_id long, text string, _text int")
    got = secret_scan.redact(d, table=table)
    assert got.columns == d.columns
    assert [r.text for r in got.orderBy("doc_id").collect()] == ["my key is <SECRET> ok", rows[1][1], None, "", 'é <SECRET>" end']


def test_random_keys_are_found_and_identifiers_are_not(spark, table):
    """Recall by length on keys that no fit has seen, and false alarms on names of the standard library."""
    import importlib
    import string

    rng = random.Random(11)
    key = lambda n: "".join(rng.choice(string.ascii_letters + string.digits) for _ in range(n))
    keys = [(n, f"put {key(n)} in") for n in (16, 20, 24, 32) for _ in range(300)]
    names = {n for m in ("os", "socket", "ssl", "errno", "signal", "locale", "asyncio", "unittest", "xml.sax", "decimal", "stat", "tokenize") for n in dir(importlib.import_module(m))}
    d = spark.createDataFrame(keys + [(0, f"call {n} now") for n in sorted(names)], "doc_id long, text string")
    got = dict(secret_scan.find_secrets(d, table).groupBy("_row.doc_id").agg(F.avg((F.size("_random") > 0).cast("int"))).collect())
    assert got[16] >= 0.9 and min(got[20], got[24], got[32]) >= 0.95
    assert len(names) > 1000 and got[0] <= 0.01


def test_random_parts_of_longer_runs(spark, table):
    a, b = "aB3dE5fG7hI9jK1lM3nO", "Zq8XvT2kWp6RjY4mLc0H"
    texts = [f"GET /v1/customers/settings/{a} ok", f"convert_timestamp_to_default_settings_{a}", f"{a}/customers/settings/default/production/{b}", "x wQzXvKjHqPzWkXbV x", "qZxWvKjYbGfXqHzPkVwJmXcRtQzLdNsB", "see MAX_RETRIES_BEFORE_TIMEOUT_EXCEPTION", "org/apache/spark/sql/catalyst/expressions", "l" * 100_000]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = [r.text for r in secret_scan.redact(d, table=table).orderBy("doc_id").collect()]
    assert got[0] == "GET /v1/customers/settings/<SECRET> ok"
    assert got[1] == "convert_timestamp_to_default_settings_<SECRET>"
    assert got[2].startswith("<SECRET>/") and "/settings/default/" in got[2] and got[2].endswith("/<SECRET>")
    assert got[3:5] == ["x <SECRET> x", "<SECRET>"]
    assert got[5:] == texts[5:]


def test_model_spans_beyond_base_spans(spark, table):
    key = "3f9a1c5b7d2e8046af13c95b7e20d864"
    d = spark.createDataFrame([(1, f"key {key}-1a2b3c4d-5e6f7a8b end"), (2, f"key {key} end")], "doc_id long, text string")
    assert [r.text for r in secret_scan.redact(d, table=table).orderBy("doc_id").collect()] == ["key <SECRET> end"] * 2
    found = {r[0]: r[1] for r in secret_scan.find_secrets(d, table).selectExpr("_row.doc_id", "transform(_random, x -> array(x.s, x.e))").collect()}
    assert found == {1: [[4, 54]], 2: []}


def test_long_texts_stay_linear(spark, table):
    import base64
    import time

    rng = random.Random(8)
    texts = [base64.b64encode(rng.randbytes(60_000)).decode(), "/".join(rng.choice(["customers", "settings", "aB3dE5fG7hI9jK1lM3nO"]) for _ in range(2_000)), " ".join(str(rng.randrange(10**6)) for _ in range(10_000)), " ".join(f"u{i}@example.com" for i in range(2_000))]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    began = time.time()
    found = {r.doc_id: r.n for r in secret_scan.find_secrets(d, table).selectExpr("_row.doc_id", "size(_random) AS n").collect()}
    assert found[0] == 1 and found[1] > 100 and found[2] == 0
    assert time.time() - began < 20
    began = time.time()
    assert {r.doc_id: r.n for r in pii.find_personal_data(d).selectExpr("doc_id", "size(email) AS n").collect()} == {0: 0, 1: 0, 2: 0, 3: 2_000}
    assert time.time() - began < 60
    began = time.time()
    assert "aB3dE5" not in secret_scan.redact(d.where("doc_id = 1"), table=table).first().text
    assert time.time() - began < 20


# --- 8: n-gram join
def brute_components(rows, size=4, threshold=85):
    sets = []
    for _, t in rows:
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", (t or "").translate({c: c + 32 for c in range(65, 91)})) if x]
        sets.append({tuple(w[j : j + size]) for j in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set())
    root = list(range(len(rows)))

    def top(i):
        return i if root[i] == i else top(root[i])

    for i, a in enumerate(sets):
        for j in range(i):
            o = len(a & sets[j])
            if a and sets[j] and 100 * o >= threshold * (len(a) + len(sets[j]) - o):
                root[max(top(i), top(j))] = min(top(i), top(j))
    return sets, [min(rows[k][0] for k in range(len(rows)) if top(k) == top(i)) for i in range(len(rows))]


def near_copies(rng, n):
    vocabulary = [f"w{i}" for i in range(400)]
    rows, passage = [], [f"p{i}" for i in range(60)]
    for _ in range(n):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([1, 3, 8, 40, 190, 300]))] + (passage if rng.random() < 0.3 else [])
        for _ in range(rng.choice([1, 1, 2, 6])):
            t = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                t[rng.randrange(len(t))] = rng.choice(vocabulary).upper()
            rows.append(" ".join(t))
    rng.shuffle(rows)
    return [(i, t) for i, t in enumerate(rows)]


def test_ngram_join_matches_brute_force(spark, tmp_path):
    rows = near_copies(random.Random(11), 120) + [(5000, None), (5001, ""), (5002, " \t\n"), (5003, "one"), (5004, "ONE")]
    sets, roots = brute_components(rows)
    got = run(spark, tmp_path, ngram_join.op8_ngram_join, rows).set_index("doc_id")
    for (i, _), s, r in zip(rows, sets, roots, strict=True):
        assert (got.n_shingles[i], got.component_id[i]) == (len(s), r)


def test_ngram_blocks_in_parts(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ngram_join, "PART_HASHES", 500)
    rows = near_copies(random.Random(12), 40)
    _, roots = brute_components(rows)
    got = run(spark, tmp_path, ngram_join.op8_ngram_join, rows).set_index("doc_id")
    assert [got.component_id[i] for i, _ in rows] == roots


def test_keep_one_and_null_rows(spark, docs):
    kept = ngram_join.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0, len(r.text or "")) for r in kept.collect()) == [(1, 16), (2, 0), (3, 0), (4, len(LONG))]


def test_shingle_hashes_tell_sets_apart():
    a, b, c = shingles.shingle_sets(["A b c d e", "a  B\nc d e", "b c d e a"], 4)
    assert (a == b).all() and len(a) == len(c) == 2 and len(np.intersect1d(a, c)) == 1


# --- 9: media
def test_png_round_trip_and_checksums():
    payload = np.random.default_rng(0).integers(0, 256, 64 * 9, dtype=np.uint8).tobytes()
    for f in range(5):
        assert media.decode(media.encode(payload, filter_type=f)).tobytes() == payload
    data = bytearray(media.encode(payload))
    data[50] ^= 1
    with pytest.raises(ValueError, match="checksum"):
        media.decode(bytes(data))


def test_rows_of_all_filters_and_heights():
    rng = np.random.default_rng(4)
    ramp = (np.arange(64)[None, :] * 3 + np.arange(40)[:, None] * 5).astype(np.uint8)
    smooth = np.cumsum(np.cumsum(rng.integers(-1, 2, (60, 64)), axis=0), axis=1).astype(np.uint8)
    pictures = [ramp.tobytes(), smooth.tobytes(), bytes(64), b"plain words of a text. " * 64, np.tile(rng.integers(0, 256, 64, dtype=np.uint8), (9, 1)).tobytes()]
    coded = [media.encode(p) for p in pictures]
    assert len(set(np.concatenate([media.inflated(c)[:, 0] for c in coded]).tolist())) >= 4
    assert [x.tobytes() for x in media.decode_all(coded)] == pictures
    with pytest.raises(ValueError, match="unknown filter"):
        media.unfiltered([np.full((2, 65), 5, np.uint8)])


def test_media_rows(spark, tmp_path):
    rows = [(1, "é" * 100), (2, None), (3, ""), (4, LONG), (5, "é" * 100)]
    got = run(spark, tmp_path, media.op9_media, rows).set_index("doc_id")
    for i, t in rows:
        n, p = media.padded(t)
        assert tuple(got.loc[i, ["n_bytes", "payload_bytes", "payload_sha256", "tail_crc32"]]) == (n, len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-64:]))
    assert tuple(got.loc[1]) == tuple(got.loc[5])


# --- 10: BPE
def test_bpe_matches_the_library(spark, tmp_path):
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(bpe.default_tokenizer())
    rows = [(1, "Don't PANIC, it's 42!"), (2, None), (3, ""), (4, "日本 é <|startoftext|>x"), (5, LONG)]
    got = run(spark, tmp_path, bpe.op10_bpe, rows).set_index("doc_id")
    for i, t in rows:
        ids = lib.encode(t or "", add_special_tokens=False).ids
        assert tuple(got.loc[i]) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest())


# --- all
def test_odd_rows_and_empty_tables(spark, docs, empty):
    for d in (docs, empty):
        n = d.count()
        assert pii.find_personal_data(d).count() == n
        assert secret_scan.redact(d).count() == n
        assert bpe.encode(d).count() == n
        assert media.media_features(media.to_media(d)).count() == n
        assert ngram_join.ngram_components(d).count() == n
        assert license_scan.find_licenses(d).count() == 0
    labels = spark.createDataFrame([(1, 1), (None, 0), (2, None)], "doc_id long, toxic int")
    assert toxicity.drop_toxic(docs, labels).count() == docs.count()


def test_names_and_pipeline(spark):
    import corpus_pipeline

    assert [n for n in registry.queries() if n.startswith("op")] == sorted((n for n in registry.queries() if n.startswith("op")), key=lambda n: int(n[2:].split("_")[0]))
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    left = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        path = common.scratch_path(spark, name)
        stage(spark, left, SF).write.parquet(path)
        after = spark.read.parquet(path)
        assert after.columns == docs.columns
        assert after.count() <= left.count()
        left = after
    ids = corpus_pipeline.run(spark, SF)
    assert {r.doc_id for r in ids.select("doc_id").collect()} == {r.doc_id for r in left.select("doc_id").collect()}
    assert not left.where(F.col("text").rlike(secret_scan.HEX)).count()
