"""The text operators against plain versions, on small tables with nulls, empty and repeated rows, and clashing columns."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from compare import differences
from souk.llm import decontaminate, extract, jaccard, langid, mixing, oracle, pitman_yor, quality, queries, simhash, substrings, tokens, toxicity

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, score double, w long"  # two names that operators use


def plain_words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in re.split(r"[\x20\x09-\x0D]+", low) if w]


def prose(seed, n):
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefghiklmnorstuvw") for _ in range(r.randint(2, 9))) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    shared = prose("shared", 60)
    base = prose("base", 120)
    rows = [(k, prose(k, 40 + 7 * k)) for k in range(12)]
    rows += [(20, base), (21, base), (22, base + " more"), (23, None), (24, ""), (25, " \n\t"), (26, "one"), (27, "Two Words")]
    rows += [(30 + k, f"{prose(100 + k, 30)} {shared} {prose(200 + k, 25)}") for k in range(4)]
    rows += [(40, "x" * 5000), (41, "é" * 300 + " " + prose(3, 47)), (42, shared + "\n" + shared)]
    return rows


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, ("en", "fr", None)[i % 3], f"src{i % 4}" if i % 5 else None, 0.5, 1) for i, t in texts]
    return spark.createDataFrame([*rows, rows[0]], SCHEMA).repartition(3)  # one row twice


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def plain_fingerprint(text):
    w = plain_words(text)
    shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_is_that_of_all_pairs(docs, texts, empty):
    prints = {i: plain_fingerprint(t) for i, t in texts}
    reach = {i: i for i in prints}
    for _ in prints:
        for a in prints:
            for b in prints:
                if (prints[a] ^ prints[b]).bit_count() <= 3:
                    reach[a] = reach[b] = min(reach[a], reach[b])
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == len(texts) + 1
    assert {(r.doc_id, r.fp % (1 << 64), r.component_id) for r in got} == {(i, prints[i], reach[i]) for i in prints}
    kept = simhash.one_of_each_group(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == set(reach.values())
    assert simhash.near_duplicates(empty).count() == 0


@pytest.mark.parametrize("way", [simhash, jaccard])
def test_one_row_of_each_group_stays(spark, way):
    """Rows without an id are no losers by default, and rows repeated under one id stay once."""
    a, b, c, d = (prose(f"kept{k}", 90) for k in range(4))
    rows = [(None, a), (None, b), (5, b), (None, c), (None, c), (7, d), (7, d), (8, d), (9, ""), (10, None)]
    df = spark.createDataFrame([(i, t, k) for k, (i, t) in enumerate(rows)], "doc_id long, text string, w int").repartition(3)
    kept = way.one_of_each_group(df)
    assert kept.columns == df.columns
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
    assert got == sorted([(None, a), (5, b), (None, c), (7, d), (9, "")], key=str)
    assert way.one_of_each_group(df.limit(0)).count() == 0


def test_rows_of_files_are_told_apart_without_a_copy(spark, tmp_path):
    texts = [prose(f"file{k % 7}", 60) for k in range(40)]
    rows = [(k if k % 3 else None, t, 10 + k, 20 + k) for k, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, Row long, _row long").repartition(4)
    df.write.parquet(str(tmp_path / "docs"))
    stored = spark.read.parquet(str(tmp_path / "docs"))
    name, told = jaccard.numbered(stored)
    assert name == "__row" and told.select(name).distinct().count() == 40
    for source in (stored, df):
        kept = jaccard.one_of_each_group(source).collect()
        least = {min(k for k in range(40) if k % 7 == c and k % 3) for c in range(7)}
        assert {(r.doc_id, r.Row, r._row) for r in kept} == {(k, 10 + k, 20 + k) for k in least}


def test_links_of_a_dense_group_reach_all(spark):
    r = random.Random(5)
    center = r.getrandbits(63)
    values = {center} | {center ^ (1 << r.randrange(60)) ^ (1 << r.randrange(60)) for _ in range(150)}
    values |= {r.getrandbits(63) for _ in range(50)}
    prints = spark.createDataFrame([(v,) for v in values], "fp long")
    want = defaultdict(set)
    for a in values:
        for b in values:
            if (a ^ b).bit_count() <= 3:
                want[a].add(b)
    for block in (16, 4096):  # cut into blocks, and not
        got = simhash.components(simhash.links(prints, block)).collect()
        groups = {r.node: r.component for r in got}
        assert all(groups[a] == groups[b] for a in want for b in want[a] if a != b)
        assert all((groups[center] == groups.get(v, v)) == (v in groups and groups[v] == groups[center]) for v in values)


def test_similar_texts_are_those_of_all_pairs(spark):
    r = random.Random(8)
    texts = []
    for k in range(12):
        base = prose(f"near{k}", 150).split()
        texts.append(" ".join(base))
        for _ in range(8):
            w = list(base)
            for at in r.sample(range(len(w)), r.randrange(8)):
                w[at] = "changed" + str(r.random())[2:]
            texts.append((" \n" if r.random() < 0.3 else " ").join(w).title())
    shingles = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in map(plain_words, texts)]
    reach = list(range(len(texts)))
    links = [(a, b) for a in reach for b in range(a) if 5 * len(shingles[a] & shingles[b]) >= 4 * len(shingles[a] | shingles[b])]
    for _ in texts:
        for a, b in links:
            reach[a] = reach[b] = min(reach[a], reach[b])
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    assert {x.doc_id for x in jaccard.one_of_each_group(df).collect()} == set(reach)
    # more than three bits of the other fingerprint, and similar all the same
    assert any((plain_fingerprint(texts[a]) ^ plain_fingerprint(texts[b])).bit_count() > 3 for a, b in links)


def test_blocks_of_a_band_reach_all(spark):
    base = prose("blocks", 200)
    df = spark.createDataFrame([(k, f"{base} end{k}") for k in range(60)], "row long, text string")
    found = jaccard.sketches(df.select("row", F.col("row").alias("id"), "text")).select("key", "row", "bands")
    for block in (7, 4096):
        got = {x.component for x in jaccard.components(jaccard.links(found, df, block)).collect()}
        assert len(got) == 1


def test_components_of_a_long_path(spark):
    path = [(i, i + 1) for i in range(30)] + [(100, 101), (101, 100), (7, 7)]
    found = {r.node: r.component for r in simhash.components(spark.createDataFrame(path, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(31)}, 100: 100, 101: 100}


def test_repeated_passages_are_cut_once(docs, texts, empty):
    out = {r.doc_id: r for r in substrings.without_repeats(docs).collect()}
    before = dict(texts)
    assert out.keys() == before.keys()
    assert all(out[i].text == before[i] for i in [*range(12), 20, 23, 24, 25, 26, 27, 30])  # first places and the rest
    assert out[21].text.split() == [] or len(out[21].text) < 0.2 * len(before[21])
    shared = prose("shared", 60)
    for i in (31, 32, 33):
        assert out[i]._cuts == 1 and shared not in out[i].text and out[i]._cut_words >= 40
        assert out[i].text.startswith(before[i][:100]) and out[i].text.endswith(before[i][-80:])
    assert substrings.without_repeats(empty).count() == 0


def test_chunks_cover_texts_and_shift_with_insertions():
    import numpy as np

    text = prose("chunks", 400).encode()
    cut = lambda t: {t[a:b] for a, b in zip(*substrings.chunk_bounds(np.frombuffer(t, np.uint8), np.array([0, len(t)]))[:2])}
    assert sum(map(len, cut(text))) == len(text)
    assert len(cut(text) - cut(b"some words before " + text)) < 12


def test_languages(spark, docs, empty):
    rows = [(i, t, lang) for i, (t, lang) in enumerate([("the cat and the dog are here", "en"), ("le chat et le chien sont ici", "fr")] * 8)]
    rows += [(50, "the dog", None), (51, "le chien", "en"), (52, None, "fr"), (53, "123 !!", "fr"), (54, "", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit("clash"))
    got = {r.doc_id: r for r in langid.classify(df, F.col("doc_id") < 16).collect()}
    assert got[50].lang_pred == "en" and got[51].lang_pred == "fr" and 0.5 < got[50].score <= 1
    assert [(got[i].lang_pred, got[i].score) for i in (52, 53, 54)] == [("und", 0.0)] * 3
    assert langid.classify(empty, F.lit(True)).count() == 0


def test_code_lengths_are_those_of_the_context_trees():
    train = {"a": ["abracadabra", "abc"], "b": ["bcbcbc dd"]}
    model = langid.fit(train)
    for text in ("abra", "zebra bc", "dd"):
        got = langid.code_lengths(model, [text])[0]
        for lang, bits in zip(model.languages, got):
            stream = b"   " + b"".join(t.encode() + b"   " for t in train[lang])
            counts = defaultdict(Counter)
            for i in range(3, len(stream)):
                for k in range(4):
                    counts[stream[i - k : i]][stream[i]] += 1
            want, whole = 0.0, b"   " + text.encode()
            for i in range(3, len(whole)):
                for k in range(3, -1, -1):
                    seen = counts.get(whole[i - k : i])
                    if not seen:
                        continue
                    n, q = sum(seen.values()), len(seen)
                    if seen[whole[i]]:
                        want += math.log2((n + q) / seen[whole[i]])
                        break
                    want += math.log2((n + q) / q)
                else:
                    want += 8
            assert bits == pytest.approx(want, rel=1e-5)


def test_token_counts_are_the_library_s(docs, texts, empty):
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    got = {r.doc_id: (r.n_bytes, r.n_tokens) for r in tokens.token_counts(docs, path).collect()}
    assert got == {i: (len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in texts}
    r = random.Random(2)
    parts = ["'", "s", "t", "re", "ll", " ", "  ", "\n", "a", "é", "²", "\xa0", "!", "<|endoftext|>", "'s", "\x1c", "日本", "😀"]
    odd = ["".join(r.choice(parts) for _ in range(r.randint(0, 9))) for _ in range(3000)]
    assert tokens.Counter(tokens.Vocabulary(path)).count(odd) == [len(e.ids) for e in library.encode_batch(odd, add_special_tokens=False)]
    assert tokens.token_counts(empty, path).count() == 0


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def test_automaton_finds_what_edit_distance_finds():
    terms = [("idiot", False), ("disgusting", False), ("scum", False), ("lowe", True)]
    automaton = toxicity.build(terms)
    r = random.Random(4)
    words = ["".join(r.choice("idotgsuncmlwe") for _ in range(r.randint(1, 6))) for _ in range(500)]
    for t, _ in terms:
        for _ in range(100):
            w = list(t)
            for _ in range(r.randint(0, 3)):
                k = r.randrange(len(w) + 1)
                w[k : k + r.randint(0, 1)] = r.choice(["", "x", "i", "ss"])
            words.append("".join(w) or "a")
    found = {i for i, *_ in toxicity.hits(automaton, words)}
    for i, w in enumerate(words):
        want = any(edits(w, t) <= toxicity.allowed_edits(t, s) if not s else w.startswith(t) for t, s in terms)
        assert (i in found) == want, w


def test_toxicity_learns_and_tells_quotation(spark, empty):
    rows = [(i, f"{prose(i, 30)} {'you are an idiot' if i % 3 == 0 else 'fine words'} {prose(-i - 1, 20)}") for i in range(90)]
    rows += [(200, "you idiott"), (201, 'the word "idiot" is quoted here'), (202, None), (203, ""), (204, "all fine")]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, predicted string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(90)] + [(0, 1), (999, 1), (1, None)], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.score(df, labels, F.lit(True)).collect()}
    assert all(got[i].predicted == (i % 3 == 0) for i in range(90))
    assert got[200].predicted == 1 and [got[i].predicted for i in (201, 202, 203, 204)] == [0] * 4
    assert toxicity.score(empty, labels, F.lit(True)).count() == 0
    assert {r.predicted for r in toxicity.score(df, labels.limit(0), F.lit(True)).collect()} == {0}


def test_main_text(spark):
    page = (
        "<html><head><title>T</title><style>p{}</style></head><body><nav><ul><li><a href='/'>Home</a></ul></nav><div class='top-ad'>Buy"
        " this now</div><article><h1>A &amp; B</h1><p>Some <b>words\n\n here<p>Short.<p class=comment>rude words</p></article>"
        "<form>Name <input name=x></form><footer>&copy; me</footer><script>var a='<p>no</p>'"
    )
    rows = [(1, page, "u"), (2, None, None), (3, "", "u"), (4, "plain text &#233;", "u")]
    df = spark.createDataFrame(rows, "page_id long, html string, n_chars string")
    got = {r.page_id: (r.text, r.n_chars) for r in extract.extract(df).collect()}
    text = "A & B\nSome words here\nShort."
    assert got == {1: (text, len(text)), 2: ("", 0), 3: ("", 0), 4: ("plain text é", 12)}
    assert extract.extract(df.limit(0)).count() == 0


def test_reparameterised_questions_are_found(spark):
    items = [(1, "A train with Tom left at 5 km. Then Tom Smith ran 7 miles to Paris and Tom ate 12 apples"), (2, "short one"), (3, ""), (4, None)]
    said = "A train with {0} left at 9 km. Then {0} Jones ran 3 feet to Rome and {1} ate 4 apples"
    rows = [(1, "So. " + said.format("Bob", "Bob")), (2, said.format("Bob", "Ann")), (3, "what a short one it is"), (4, None), (5, "")]
    q = spark.createDataFrame(items, "item_id int, text string")
    d = spark.createDataFrame([(*r, 0) for r in [*rows, rows[0]]], "doc_id int, text string, item_id int")
    got = {(r.doc_id, r.item_id, r.changed) for r in decontaminate.leaks(d, q).collect()}
    assert got == {(1, 1, True), (3, 2, False)}
    assert sorted(r.doc_id for r in decontaminate.without_leaks(d, q).collect()) == [2, 4, 5]
    assert decontaminate.leaks(d.limit(0), q).count() == 0 and decontaminate.leaks(d, q.limit(0)).count() == 0


def test_long_lists_of_names_and_numbers_end(spark):
    lists = [(1, "a " + "Anna " * 200_000), (2, "1," * 200_000 + "1"), (3, "x 5 km " * 50_000)]
    docs = spark.createDataFrame(lists, "doc_id long, text string")
    n = decontaminate
    got = docs.select("doc_id", n.template(docs.text).alias("t"), F.size(n.valued(docs.text)).alias("v")).collect()
    assert {r.doc_id: (len(r.t), r.v) for r in got} == {1: (2, 2), 2: (2, 2), 3: (150_000, 150_000)}


def test_quality_of_odd_rows(docs, texts, empty):
    got = {r.doc_id: r for r in quality.rated(docs).collect()}
    for i, t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        c = Counter(zip(w, w[1:], w[2:]))
        covered = {k + o for k in range(len(w) - 2) if c[tuple(w[k : k + 3])] > 1 for o in range(3)}
        assert (got[i].n_words, got[i].word_chars, got[i].n_repeat_words) == (len(w), sum(map(len, w)), len(covered))
        assert got[i].base_failed == (len(w) < 50 or 2 * len(covered) > len(w)) and not (got[i].base_failed and got[i].kept)
    assert quality.rated(empty).count() == 0
    assert quality.chi_square(quality.chi_square_point(0.95, 5), 5) == pytest.approx(0.95) and quality.chi_square_point(0.95, 5) == pytest.approx(11.07, abs=0.01)


def test_shortages_go_to_siblings_first(spark, empty):
    leaves = [("a", "x", "s1", 10), ("a", "x", "s2", 1000), ("a", "y", "s3", 1000), ("b", "x", "s4", 1000)]
    df = spark.createDataFrame(leaves, "_domain string, _lang string, _source string, tokens long")
    given = {r._source: r.given for r in mixing.budgets(df, 0.2, 1, [{}, {}, {}]).collect()}
    # 602 tokens: 301 each domain, 150 each language of a; s1 has 10 and its sibling takes the rest
    assert given == {"s1": 10, "s2": 140, "s3": 150, "s4": 301}
    assert mixing.mix(empty, F.lit("d"), [{}, {}, {}]).count() == 0


def test_pitman_yor_is_a_distribution_and_base_is_plain(spark, docs, texts, empty):
    got = pitman_yor.score(docs, F.col("doc_id") % 7 != 2).collect()
    assert len(got) == len(texts) + 1
    train = Counter(w for i, t in [*texts, texts[0]] if i % 7 != 2 for w in [*plain_words(t), None])
    n, v = sum(train.values()), len(train)
    for r in got:
        w = [*plain_words(dict(texts)[r.doc_id]), None]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(w), sum(train[x] > 0 for x in w), n)
        assert r.base_score == pytest.approx(sum(math.log10((train[x] + 1) / (n + v + 1)) for x in w))
    # every one-word text with one end: the first words' probabilities sum to one, the unknown word included
    few = [(i, w) for i, w in enumerate(["a b a", "b a c", "a a"])]
    probes = [(100 + i, w) for i, w in enumerate(["a", "b", "c", "zz", ""])]
    df = spark.createDataFrame(few + probes, "doc_id long, text string")
    out = {r.doc_id: r.score for r in pitman_yor.score(df, F.col("doc_id") < 100).collect()}
    assert all(x < 0 for x in out.values()) and out[100] > out[103]
    assert pitman_yor.score(empty, F.lit(True)).count() == 0


def test_sweeps_use_the_totals_of_the_sweep_before(spark, docs):
    import numpy as np
    import pyarrow as pa

    texts = docs.select("text")
    n, v = pitman_yor.word_counts(texts).groupBy().agg(F.sum("n"), F.count("*")).first()
    restaurants = pitman_yor.pair_counts(texts, spark.sparkContext.broadcast(np.zeros(0, np.uint64))).localCheckpoint()
    totals = pitman_yor.all_totals(restaurants, n, 1 / (v + 1))
    rows = restaurants.collect()
    kind = pa.list_(pa.struct([("u", pa.int16()), ("n", pa.int64())]))
    pairs = pa.array([[{"u": p.u, "n": p.n} for p in r.pairs] for r in rows], kind)
    plain = pitman_yor.Words(pa.RecordBatch.from_arrays([pa.array([r.w for r in rows]), pairs], ["w", "pairs"]), 1 / (v + 1))
    plain.first(n)
    for turn, (tables, root) in enumerate(totals):
        assert (tables == np.bincount(plain.u, plain.t, pitman_yor.CONTEXTS)).all() and root == plain.s.sum()
        plain.sweep(tables, root, turn + 1)
    assert len(totals) == pitman_yor.BURN_IN + pitman_yor.KEPT and any((t != totals[0][0]).any() for t, _ in totals[1:])
    # the sums handed on are those of the kept sweeps, the last one included
    last = pitman_yor.seated(restaurants, n, 1 / (v + 1), totals).where(f"w is null and n = {pitman_yor.KEPT - 1}").collect()
    assert sum(r.a[0] for r in last) == plain.s.sum()


def test_seating_stays_within_customers():
    import numpy as np

    c = np.array([0, 1, 2, 50, 1000, 100000])
    t = pitman_yor.seat(c, np.full(6, 3.0), 0.75, np.arange(6, dtype=np.uint64))
    assert list(t[:2]) == [0, 1] and (t[2:] >= 1).all() and (t <= np.maximum(c, 0)).all() and (np.diff(t) >= 0).all()


@pytest.mark.skipif(not Path(SMALL).exists(), reason="no test data")
@pytest.mark.parametrize("name", oracle.oracle_sql())
def test_same_result_as_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    assert differences(queries.queries()[name](spark, SMALL), oracle.oracle_sql()[name], con) == ""


@pytest.mark.skipif(not Path(SMALL).exists(), reason="no test data")
def test_pipeline_keeps_what_plain_rules_keep(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    known = stages["language"](spark, docs, SMALL).collect()
    assert {r.doc_id for r in known} == {r.doc_id for r in docs.collect() if re.search(r"[^\W\d_]", r.text or "")}
    out = corpus_pipeline.run(spark, SMALL)
    assert out.columns == [*docs.columns, "domain", "epochs"]
    prints = {r.doc_id: plain_fingerprint(r.text) for r in known}
    near = {i for i in prints if any(j < i and (prints[i] ^ prints[j]).bit_count() <= 3 for j in prints)}
    rows = out.collect()
    assert rows and not near & {r.doc_id for r in rows} and all(r.epochs > 0 and r.n_chars == len(r.text) for r in rows)
    assert zlib.crc32(b"0") and len({r.doc_id for r in rows}) == len(rows)
