"""Token files, periodic runs and conversation repair against plain versions, with odd rows."""

import hashlib
import heapq
import random
import zlib
from itertools import product

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from souk.llm import conversations, queries, runs, token_files
from souk.llm.elias_fano import EliasFano, encode

SMALL = "/root/testdata/sf0.001"
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


# --- Elias-Fano -----------------------------------------------------------------------


@settings(deadline=None, max_examples=60)
@given(st.lists(st.integers(0, 10**12)), st.integers(0, 3))
def test_elias_fano_gives_every_number_back(values, pad):
    values = sorted(values)
    code = EliasFano(b"x" * 8 * pad + encode(np.array(values, np.int64)), 8 * pad)
    assert code.all().tolist() == values == [code[i] for i in range(len(code))]


@pytest.mark.parametrize("step", [0, 1, 3, 700, 10**6])
def test_selects_across_the_directory(step):
    r = np.random.default_rng(step)
    values = np.cumsum(r.integers(0, step + 1, 5000) * (r.random(5000) < 0.3))
    code = EliasFano(encode(values))
    assert [code[i] for i in range(0, 5000, 37)] == values[::37].tolist()
    for v in (0, int(values[2500]), int(values[-1]) + 1):
        assert code.up_to(v) == np.searchsorted(values, v, "right")
    # near the bound of 2 + log2(u / n) bits a number, with the directory and a head of 28 bytes
    assert len(encode(values)) * 8 <= 5000 * (2.5 + np.log2(max(int(values[-1]) / 5000, 1)) + 32 / 256) + 8 * 40
    with pytest.raises(IndexError):
        code[5000]


ODD_TEXTS = [
    "", None, " \t\r\n", "Don't STOP, it's 2024!", "a<|endoftext|>b <|startoftext|>", "ΟΔΟΣ ΣΑΣ. İstanbul", "é ́x a b c\x1cd\x85e",
    "🙂👍🏽 ok", "日本語 テキスト", "x" * 3000, "word " * 2000, "\x00\x01 z", "'s 't're 'LL",
]


def test_token_files_hold_what_the_library_gives(spark, monkeypatch):
    monkeypatch.setattr(token_files, "FILE_TOKENS", 500)
    monkeypatch.setattr(token_files, "KEPT_WORDS", 3)  # the kept words are let go again and again
    rows = [(k * 7 - 20, t, k) for k, t in enumerate(ODD_TEXTS)]
    rows += [rows[3], rows[3], (None, "no id", 1), (None, None, 2), (2**40, "far", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start long").repartition(3)
    got = token_files.stored(docs, WORD_BPE, 1).collect()
    library = Tokenizer.from_file(WORD_BPE)
    want = []
    for doc_id, text, _ in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        want.append((doc_id, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    assert sorted(map(str, ((r.doc_id, r.n_tokens, r.ids_crc32) for r in got))) == sorted(map(str, want))
    at = 0
    for row in sorted(got, key=lambda r: r.start):  # the starts leave no gap and follow the ids
        assert row.start == at
        at += row.n_tokens
    order = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert order[:2] == [None, None] and order[2:] == sorted(order[2:])
    assert token_files.stored(docs.limit(0), WORD_BPE, 1).count() == 0


def test_words_have_the_tokens_of_their_text():
    library, encoder = Tokenizer.from_file(WORD_BPE), token_files.Encoder(WORD_BPE)

    @settings(deadline=None, max_examples=300)
    @given(st.lists(st.text(max_size=30) | st.text(st.characters(max_codepoint=255), max_size=30), max_size=6).map(" ".join))
    def same(text):
        got = np.frombuffer(encoder.texts([text.encode()])[0], "<u2").tolist()
        assert got == library.encode(text, add_special_tokens=False).ids

    same()
    assert encoder.merges is not None
    for text in ("Étion dans, ÇOUELLE ß ÿ. un; x! Ÿ? a,b a.. .a µ ª º × don't", "".join(map(chr, range(33, 0x250)))):
        for word in [text, *text.split(), *text]:
            got = np.frombuffer(encoder.texts([word.encode()])[0], "<u2").tolist()
            assert got == library.encode(word, add_special_tokens=False).ids
    bytes_only = token_files.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    assert bytes_only.merges is None


def test_a_file_is_read_without_its_other_documents(tmp_path):
    docs = [np.arange(k % 5, dtype="<u2") + k for k in range(2000)]
    path = tmp_path / "a.tokens"
    path.write_bytes(token_files.file_bytes([None, None, *range(-5, 2 * 1998 - 5, 2)], [d.tobytes() for d in docs], 2))
    found = token_files.TokenFile.open(str(path))
    assert [found.doc_id(i) for i in (0, 1, 2, 3, 1999)] == [None, None, -5, -3, 3989]
    for i in (0, 1, 4, 1000, 1999):
        assert found.document(i).tolist() == docs[i].tolist()
    starts = np.cumsum([0, *map(len, docs)])
    for token in (0, 1, 77, found.n_tokens - 1):
        i = found.holding(token)
        assert starts[i] <= token < starts[i + 1]
    assert path.stat().st_size < 2 * found.n_tokens + 2000  # both codes in less than a byte a document


# --- runs -----------------------------------------------------------------------------


def plain_runs(s, min_words=24, min_periods=3):
    found = set()
    for q in range(1, len(s) // min_periods + 1):
        i = 0
        while i + q < len(s):
            j = i
            while j + q < len(s) and s[j] == s[j + q]:
                j += 1
            n = j + q - i
            long = j > i and n >= max(min_words, min_periods * q)
            if long and not any(2 * r <= n and all(s[x] == s[x + r] for x in range(i, i + n - r)) for r in range(1, q)):
                found.add((i, n, q))
            i = max(j, i + 1)
    return sorted(found)


def plain_row(doc_id, text):
    w = (text or "").encode().split()
    n = len(w)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = plain_runs(w)
    best = max(found, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None,) * 3)
    gone = {i for s, k, q in found for i in range(s + q, s + k)}
    lines = "".join(f"{s},{k},{q}\n" for s, k, q in found)
    kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
    milli = None if best[0] is None else 1000 * best[1] // best[2]
    return (doc_id, len(found), *best, milli, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def repetitive(r, n):
    out = []
    while len(out) < n:
        block = [r.choice("abcdefg"[: r.choice((1, 2, 3, 7))]) for _ in range(r.randrange(1, 9))]
        out += block * r.randrange(1, 9)
    return out[:n]


def longest_lyndon_words(s):
    out = []
    for i in range(len(s)):
        k, j = i, i + 1
        while j < len(s) and s[k] <= s[j]:
            k = i if s[k] < s[j] else k + 1
            j += 1
        out.append(j - k)
    return out


def test_grouping_gives_the_lyndon_array():
    for n in range(8):
        for s in product(range(3), repeat=n):
            assert runs.lyndon_array(list(s)) == longest_lyndon_words(s)
    r = random.Random(5)
    for _ in range(200):
        s = [ord(c) for c in repetitive(r, r.randrange(1, 120))]
        assert runs.lyndon_array(s) == longest_lyndon_words(s)


@pytest.mark.parametrize(("least", "periods"), [(24, 3), (2, 2)])
def test_runs_are_those_of_every_period(least, periods):
    r = random.Random(least)
    for _ in range(150):
        s = repetitive(r, r.randrange(1, 150))
        assert runs.find_runs(np.array([ord(c) for c in s]), least, periods) == plain_runs(s, least, periods)


def test_unequal_words_with_one_hash_are_told_apart(monkeypatch):
    s = [0, 1, 2, 3] * 10 + [0, 1, 2, 4] * 9 + list(range(9))
    wanted = plain_runs(s)
    monkeypatch.setattr(runs, "mixed", lambda v: np.minimum(v, np.uint64(4)))  # 3 and 4 collide
    assert runs.find_runs(np.array(s)) == wanted != []


def test_runs_of_texts(spark):
    r = random.Random(8)
    texts = [(k, " \n".join(repetitive(r, r.randrange(0, 200)))) for k in range(120)]
    texts += [(None, "a b " * 30), (500, None), (501, ""), (502, "\t "), (503, "x"), (504, "é ü " * 40 + "z"), (505, "y" * 100_000)]
    texts += [(k, " ".join(f"w{i * 7919 % 1000}" for i in range(400))) for k in range(600, 640)]
    texts += [texts[0], (506, " ".join(f"w{i}" for i in range(3000)) + " a b c" * 20_000)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    assert any(zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in texts if i is not None)
    found = runs.with_runs(docs.select("doc_id", runs.periodic(docs.doc_id, docs.text).alias("text")))
    for row in found.where("doc_id < 130").collect():
        assert [tuple(x) for x in row.runs] == plain_runs(row.text.split())
    big = found.where("doc_id = 506").first()
    assert [tuple(x) for x in big.runs] == [(3000, 60_000, 3)] and big.collapsed.endswith("w2999 a b c")
    assert runs.with_runs(docs.limit(0)).count() == 0
    with pytest.raises(ValueError, match="runs"):
        runs.with_runs(docs.withColumnRenamed("doc_id", "RUNS"))


def test_run_query_is_that_of_plain_words(spark, tmp_path):
    r = random.Random(4)
    texts = [(k, "  ".join(repetitive(r, r.randrange(0, 150)))) for k in range(80)]
    texts += [(k, " ".join(f"w{i * 7919 % 1000}" for i in range(100 + k))) for k in range(600, 640)]
    texts += [(700, None), (701, " "), (None, "q " * 50), texts[0]]
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(x) for x in queries.queries()["op12_periodic_runs"](spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == sorted((plain_row(*t) for t in texts), key=str)


# --- conversations --------------------------------------------------------------------

NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}


def cheapest_path(symbols):
    """Dijkstra over rows and states, by cost and letters; symbols are (initial, cut) or None."""
    heap, done = [(0, "", 0, 0)], set()
    while heap:
        cost, letters, i, state = heapq.heappop(heap)
        if i == len(symbols) and state in (0, 3):
            return cost, letters
        if (i, state) in done:
            continue
        done.add((i, state))
        for role in "ua":
            if (state, role) in NEXT:
                heapq.heappush(heap, (cost + 5, letters + "I", i, NEXT[state, role]))
        if i < len(symbols):
            heapq.heappush(heap, (cost + 2, letters + "D", i + 1, state))
            if symbols[i]:
                initial, cut = symbols[i]
                for role, letter, extra in ((initial, "K", 0), ("u", "R", 1), ("a", "R", 1)):
                    if (state, role) in NEXT:
                        heapq.heappush(heap, (cost + extra + 5 * cut, letters + letter, i + 1, NEXT[state, role]))
    raise AssertionError


def test_block_tables_find_the_cheapest_edits():
    kinds = [(r, c) for r in "suao" for c in (0, 1)] + [None]
    for n in range(5):
        for s in product(range(9), repeat=n):
            if n < 4 or sum(s) % 7 == 0:
                assert conversations.cheapest(bytes(s)) == cheapest_path([kinds[k] for k in s])
    r = random.Random(1)
    for _ in range(1500):
        s = bytes(r.choice((2, 4, r.randrange(9))) for _ in range(r.randrange(4, 30)))
        assert conversations.cheapest(s) == cheapest_path([kinds[k] for k in s])
    cost, letters = conversations.cheapest(bytes((2, 4)) * 200_000)
    assert cost == 0 and letters == "K" * 400_000


def plain_repair(rows):
    """``rows`` are (conv, turn, role, text) as stored."""
    held = {}
    for conv, turn, role, text in rows:
        part = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = (" " if role is None else role), (" " if text is None else text)
        text = "" if part == 1 else "".join(c for c in text if c not in ".!?") if part == 2 else text
        role = "user" if part == 4 else role
        held.setdefault(conv, []).extend([(turn, role, text)] * (0 if part == 0 else 2 if part == 3 else 1))
    out = {}
    for conv, some in held.items():
        some.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).digest()))
        turns = [t for t, _, _ in some if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        faults, symbols, seen = [], [], set()
        for _, role, text in some:
            bare = text.strip(" \t\n\x0b\x0c\r")
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
            seen.add((role, text))
            faults.append(fault)
            symbols.append(None if fault in ("blank", "duplicate") else (role[:1], int(fault == "truncated")))
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(some, some[1:]))
        cost, audit = cheapest_path(symbols)
        lines, state, i = [], 0, 0
        for letter in audit:
            role = {0: "user", 1: "user", 2: "assistant", 3: "user"}[state]
            if letter == "I":
                lines.append(f"{role}:")
            elif letter != "D":
                role = some[i][1] if letter == "K" else role
                lines.append(f"{role}:{some[i][2]}")
            i += letter != "I"
            state = state if letter == "D" else NEXT[state, role[:1]]
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out[conv] = (conv, gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest)
    return out


def test_repaired_conversations_are_those_of_plain_search(spark, tmp_path):
    r = random.Random(2)
    texts = ["Yes.", "No!", "Why?", "and so", "", " \n", None, "ok. \t", "Ünd.", "a.b"]
    rows = []
    for conv in range(150):
        for turn in range(r.randrange(1, 9)):
            role = r.choice(("user", "assistant")) if r.random() < 0.3 else ("user", "assistant")[turn % 2]
            role = r.choice(("system", "tool", None, "", "Sys")) if r.random() < 0.1 else role
            rows.append((conv, turn + (turn > 3), role, r.choice(texts) if r.random() < 0.4 else f"Text {conv} {turn}."))
    rows += [(None, t, "user", "x.") for t in (0, 1, None)] + [(900, None, "assistant", "y."), (900, None, None, None)]
    rows += [(901, t, ("user", "assistant")[t % 2], f"{t}.") for t in range(900)] + [rows[0], rows[5]]
    alone = next(k for k in range(1000, 2000) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    rows.append((alone, 0, "user", "gone."))
    path = f"{tmp_path}/conversations.parquet"
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5).write.parquet(path)
    got = {x[0]: tuple(x) for x in queries.queries()["op13_conversation_repair"](spark, str(tmp_path)).collect()}
    assert got == plain_repair(rows)
    assert got[alone] == (alone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    spark.createDataFrame([], "conv_id long, turn long, role string, text string").write.mode("overwrite").parquet(path)
    assert queries.queries()["op13_conversation_repair"](spark, str(tmp_path)).count() == 0
