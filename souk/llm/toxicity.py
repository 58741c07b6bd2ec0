"""Toxicity: a learned lexicon, misspellings through Levenshtein automata, and the context of each hit.

The lexicon holds words, and beginnings of words, that stand in toxic texts far more often than
chance allows. Its trie intersected with Levenshtein automata gives one deterministic automaton,
which reads all words of many texts at once. Hits are counted apart by whether they are spelled exactly and
whether their surroundings quote them or address somebody; a logistic regression weighs the counts.
"""

from collections.abc import Iterator
from dataclasses import dataclass, field
from math import comb, log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from souk.llm.arrays import LOWER, pieces, span_hashes, text_slices, words
from souk.session import materialize

#: Labelled texts that lexicon and weights are learned from, at most about so many.
SAMPLE_ROWS = 10_000
#: A term's chance of standing by accident in so many toxic texts, times the terms tried, is below this.
CHANCE = 0.3
MIN_PRECISION = 0.7
#: Texts from which on terms are not told apart when counting the terms tried.
MANY = 64
#: Letters of a beginning, how many times the texts of its best word it must reach, and its precision.
STEM_LETTERS, STEM_GAIN, STEM_PRECISION = (3, 4, 5, 6, 7, 8), 1.5, 0.9
#: Edits allowed from so many letters on.
EDITS = ((10, 2), (5, 1))
#: Characters around a hit that are read as its context, and texts read at once.
CONTEXT, READ_CHARS = 60, 1 << 19

# Words that report what somebody else wrote, and words that address or describe somebody.
REPORTING = frozenset(
    "said says quote quoted quotes wrote writes word words term called meaning definition sagte schrieb wort zitat zitiert "
    "begriff dit écrit mot cite citation terme dijo escribió palabra cita término".split()
)
ADDRESSING = frozenset(
    "you your you're are is such du dein bist ist ihr sie seid tu ton es vous êtes est tú eres usted son".split()
)
OPENING, CLOSING, STRAIGHT = "“„«‘", "”»’", "\"'"


@dataclass
class Automaton:
    """``classes``: the letter class of each code point (0 ends a word); ``steps`` by state and class; ``term`` and ``edits`` of a state.

    State 0 is dead. A state with ``final`` has read a lexicon beginning and accepts whatever follows.
    """

    classes: np.ndarray
    steps: np.ndarray
    term: np.ndarray
    edits: np.ndarray
    final: np.ndarray
    longest: int
    strong: list[bool] = field(default_factory=list)


@dataclass
class Model:
    automaton: Automaton
    weights: np.ndarray
    terms: list[tuple[str, bool]] = field(default_factory=list)


def allowed_edits(term: str, stem: bool) -> int:
    return 0 if stem else next((e for letters, e in EDITS if len(term) >= letters), 0)


_word_mask: list[np.ndarray] = []


def word_characters() -> np.ndarray:
    """True for code points of words: letters, digits and signs used in place of letters."""
    if not _word_mask:
        mask = np.fromiter((chr(c).isalnum() for c in range(0x110000)), bool, 0x110000)
        mask[[ord(c) for c in "@$*"]] = True
        _word_mask.append(mask)
    return _word_mask[0]


def build(terms: list[tuple[str, bool]], exact: frozenset[int] = frozenset()) -> Automaton:
    """The trie of ``(term, is a beginning)`` intersected with Levenshtein automata, by subsets; terms in ``exact`` allow no edits."""
    most_of = [0 if i in exact else allowed_edits(*t) for i, t in enumerate(terms)]
    letters = sorted({c for t, _ in terms for c in t})
    code = {c: i + 2 for i, c in enumerate(letters)}
    classes = word_characters().astype(np.uint8)  # 1: a letter of no term
    assert len(letters) < 254
    for c, i in code.items():
        classes[ord(c)] = i
        if len(c.upper()) == 1:
            classes[ord(c.upper())] = i
    children: list[dict[int, int]] = [{}]
    ends: dict[int, int] = {}
    reach = [0]
    for i, (term, _) in enumerate(terms):
        node, most = 0, most_of[i]
        reach[0] = max(reach[0], most)
        for c in term:
            if code[c] not in children[node]:
                children[node][code[c]] = len(children)
                children.append({})
                reach.append(0)
            node = children[node][code[c]]
            reach[node] = max(reach[node], most)
        ends[node] = i

    def closed(states: dict[int, int]) -> tuple:
        """Adds letters of the term left out; of a node the fewest edits count."""
        waiting = list(states.items())
        while waiting:
            node, e = waiting.pop()
            if states.get(node, 99) < e:
                continue
            for child in children[node].values():
                if e + 1 <= reach[child] and e + 1 < states.get(child, 99):
                    states[child] = e + 1
                    waiting.append((child, e + 1))
        return tuple(sorted(states.items()))

    sticky = {n for n, i in ends.items() if terms[i][1]}
    start = closed({0: 0})
    number = {(): 0, start: 1}
    queue, steps = [start], {0: [0] * (len(letters) + 2)}
    while queue:
        state = queue.pop()
        row = [0] * (len(letters) + 2)
        for c in range(1, len(letters) + 2):
            to: dict[int, int] = {}
            for node, e in state:
                if c in children[node]:
                    child = children[node][c]
                    to[child] = min(to.get(child, 99), e)
                if e < reach[node]:
                    to[node] = min(to.get(node, 99), e + 1)  # one letter more in the text
                for child in children[node].values():
                    if e + 1 <= reach[child]:
                        to[child] = min(to.get(child, 99), e + 1)
            hit = [n for n in to if n in sticky and to[n] == 0]
            after = ((hit[0], 0),) if hit else closed(to)
            if after not in number:
                number[after] = len(number)
                if hit:
                    steps[number[after]] = [number[after]] * (len(letters) + 2)
                else:
                    queue.append(after)
            row[c] = number[after]
        steps[number[state]] = row
    term, edits = np.full(len(number), -1, np.int32), np.zeros(len(number), np.int8)
    final = np.zeros(len(number), bool)
    for state, k in number.items():
        found = [(e, ends[n]) for n, e in state if n in ends and e <= most_of[ends[n]]]
        if found:
            edits[k], term[k] = min(found)
            final[k] = len(state) == 1 and state[0][0] in sticky
    longest = max((len(t) + most for (t, _), most in zip(terms, most_of, strict=True)), default=0)
    table = np.array([steps[k] for k in range(len(number))], np.int32)
    return Automaton(classes, table, term, edits, final, longest)


def hits(automaton: Automaton, texts: list[str]) -> Iterator[tuple[int, int, int, int, int]]:
    """``(text, begin, end, term, edits)`` of each word that the automaton accepts."""
    joined = "\n".join(texts) + "\n"
    kinds = automaton.classes[np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)]
    inside = kinds > 0
    edge = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    starts, ends = edge[::2], edge[1::2]
    state = np.ones(len(starts), np.int32)
    live = np.arange(len(starts))
    for k in range(automaton.longest + 1):
        live = live[starts[live] + k < ends[live]]
        if not len(live):
            break
        state[live] = automaton.steps[state[live], kinds[starts[live] + k]]
        live = live[(state[live] > 0) & ~automaton.final[state[live]]]
    state[live[ends[live] - starts[live] > automaton.longest + 1]] = 0
    begins = np.cumsum([0, *(len(t) + 1 for t in texts)])
    for w in np.flatnonzero(automaton.term[state] >= 0).tolist():
        text = int(np.searchsorted(begins, starts[w], "right")) - 1
        yield text, int(starts[w] - begins[text]), int(ends[w] - begins[text]), int(automaton.term[state[w]]), int(automaton.edits[state[w]])


def quoted(text: str, begin: int, end: int) -> bool:
    """Whether the hit stands in quotation marks or just after a word of reporting."""
    left, right = text[max(0, begin - CONTEXT) : begin], text[end : end + CONTEXT]
    if max(map(left.rfind, OPENING)) > max(map(left.rfind, CLOSING)):
        return True
    if left.count('"') % 2 and '"' in right:
        return True
    near = left[-1:] in STRAIGHT and right[:1] in STRAIGHT and left[-1:] != ""
    return bool(near) or not REPORTING.isdisjoint(_bare(left.split()[-3:]))


def addressed(text: str, begin: int) -> bool:
    return not ADDRESSING.isdisjoint(_bare(text[max(0, begin - CONTEXT) : begin].split()[-3:]))


def _bare(words: list[str]) -> list[str]:
    return [w.lower().strip(".,;:!?\"'()") for w in words]


#: Share of toxic texts among those of a term, one clean text added, from which on a single hit may tell.
STRONG = 0.95
FEATURES = 7


def features(automaton: Automaton, texts: list[str]) -> np.ndarray:
    """Per text whether it has a plain hit of a strong term, a misspelled one, one that addresses somebody, and a quoted one; and
    whether there are one, two and three or more plain hits of weaker terms.

    A misspelled hit is a hit too, so that it weighs as much unless the labels tell otherwise.
    """
    counts = np.zeros((len(texts), FEATURES))
    for i, begin, end, term, edits in hits(automaton, texts):
        if quoted(texts[i], begin, end):
            counts[i, 3] = 1
        elif automaton.strong[term]:
            counts[i, 0] = 1
            counts[i, 1] = max(counts[i, 1], edits > 0)
            counts[i, 2] = max(counts[i, 2], addressed(texts[i], begin))
        else:
            counts[i, 4 + min(2, int(counts[i, 4:].sum()))] = 1
    return counts


def regression(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, steps: int = 60) -> np.ndarray:
    """Weights of a logistic regression with a constant, by Newton's method; quotation never counts for toxicity more than abuse."""
    a = np.column_stack((np.ones(len(x)), x))
    w = np.zeros(a.shape[1])
    if not len(x) or y.min() == y.max():
        return w + np.eye(1, a.shape[1])[0] * (-4.0 if not len(x) or not y.max() else 4.0)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        grad = a.T @ (p - y) / len(y) + ridge * w
        hess = (a * (p * (1 - p))[:, None]).T @ a / len(y) + ridge * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return w


def scores(model: Model, texts: list[str]) -> np.ndarray:
    out = np.empty(len(texts))
    begin = 0
    while begin < len(texts):
        end, size = begin, 0
        while end < len(texts) and (end == begin or size + len(texts[end]) <= READ_CHARS):
            size += len(texts[end])
            end += 1
        x = features(model.automaton, texts[begin:end])
        out[begin:end] = 1 / (1 + np.exp(-(model.weights[0] + x @ model.weights[1:])))
        begin = end
    return out


def one_of_copies(sample: DataFrame) -> DataFrame:
    """``(text, toxic)``: of sampled texts with the same least hash of five words, likely copies, one for each label.

    Else the words of a text copied often would seem to stand in many texts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            least = []
            for _, _, data, offsets in text_slices(batch.column(0)):
                starts, ends, doc = words(data, offsets)
                last = np.minimum(np.arange(len(doc)) + 4, np.searchsorted(doc, doc, "right") - 1)
                low = np.full(len(offsets) - 1, np.iinfo(np.uint64).max)
                np.minimum.at(low, doc, span_hashes(LOWER[data], starts, ends[last]))
                least.append(low.view(np.int64))
            found = pa.array(np.concatenate(least)) if least else pa.array([], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, found], ["text", "toxic", "least"])

    kind = sample.schema["toxic"].dataType.simpleString()
    marked = sample.select("text", "toxic").mapInArrow(run, f"text string, toxic {kind}, least long")
    return materialize(marked.groupBy("least", "toxic").agg(F.min("text").alias("text")).select("text", "toxic"), "labelled-sample")


def term_counts(sample: DataFrame) -> DataFrame:
    """``(term, stem, toxic, clean)``: texts of either label with each word and each beginning of a longer word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            toxic = batch.column(1).to_pylist()
            seen: dict[tuple[str, bool], list[int]] = {}
            for text, label in zip(batch.column(0).to_pylist(), toxic, strict=True):
                words = {w for w in ("".join(c if c.isalnum() else " " for c in text)).lower().split() if w.isalpha() and 3 <= len(w) <= 24}
                terms = {(w, False) for w in words} | {(w[:n], True) for w in words for n in STEM_LETTERS if len(w) > n}
                for t in terms:
                    seen.setdefault(t, [0, 0])[1 - label] += 1
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([t for t, _ in seen], pa.string()),
                    pa.array([s for _, s in seen], pa.bool_()),
                    pa.array([n[0] for n in seen.values()], pa.int64()),
                    pa.array([n[1] for n in seen.values()], pa.int64()),
                ],
                ["term", "stem", "toxic", "clean"],
            )

    rows = sample.select("text", "toxic").mapInArrow(run, "term string, stem boolean, toxic long, clean long")
    return rows.groupBy("term", "stem").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def lexicon(rows: list[tuple[str, bool, int, int]], toxic: int, clean: int, tried: dict[int, int]) -> list[tuple[str, bool]]:
    """Terms whose texts are toxic too often for chance, as there are so many terms in as many texts; a beginning only where it reaches well beyond its words."""
    share = toxic / max(1, toxic + clean)
    passed: dict[tuple[str, bool], int] = {}
    for term, stem, k, m in rows:
        as_often = sum(n for texts, n in tried.items() if texts >= min(k + m, MANY))
        chance = log(comb(k + m, k)) + k * log(max(share, 1e-12)) + log(max(1, as_often))
        if k and k >= (STEM_PRECISION if stem else MIN_PRECISION) * (k + m) and chance < log(CHANCE):
            passed[term, stem] = k
    words = {t: k for (t, stem), k in passed.items() if not stem}
    stems: list[str] = []
    for (t, stem), k in sorted(passed.items(), key=lambda x: (len(x[0][0]), x[0])):
        best = max((n for w, n in words.items() if w.startswith(t)), default=0)
        if stem and k >= STEM_GAIN * best and not t.startswith(tuple(stems)):
            stems.append(t)
    plain = [(w, False) for w in words if not stems or not w.startswith(tuple(stems))]
    return sorted(plain + [(t, True) for t in stems])


def misleading(sample: DataFrame, sent) -> frozenset[int]:
    """Terms whose misspellings stand in clean texts of the sample too often."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            labels = batch.column(1).to_pylist()
            seen = {(i, term) for i, _, _, term, edits in hits(sent.value, batch.column(0).to_pylist()) if edits}
            terms = pa.array([t for _, t in seen], pa.int32())
            yield pa.RecordBatch.from_arrays([terms, pa.array([labels[i] for i, _ in seen], pa.int64())], ["term", "toxic"])

    rows = sample.select("text", "toxic").mapInArrow(run, "term int, toxic long").groupBy("term")
    share = rows.agg(F.avg("toxic").alias("share")).where(F.col("share") < MIN_PRECISION)
    return frozenset(r["term"] for r in share.collect())


def fit(docs: DataFrame, labels: DataFrame, training: Column, id_col: str, text_col: str, sample_rows: int) -> Model:
    spark = docs.sparkSession
    known = labels.where(F.col("toxic").isin(0, 1)).where(training).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n = known.count()
    place = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit("toxicity")), F.lit(1 << 20)) / float(1 << 20)
    chosen = known.where(place < min(1.0, sample_rows / max(1, n)))  # about sample_rows rows: small enough to send to all
    texts = docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    sample = one_of_copies(texts.join(F.broadcast(chosen), "doc_id"))
    totals = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    counted = term_counts(sample)
    toxic, clean = totals.get(1, 0), totals.get(0, 0)
    rows, tried = [], {}
    if toxic:
        least = max(3, 0.002 * toxic)
        texts_of = F.least(F.col("toxic") + F.col("clean"), F.lit(MANY))
        tried = {r["k"]: r["n"] for r in counted.groupBy(texts_of.alias("k")).agg(F.count("*").alias("n")).collect()}
        often = counted.where((F.col("toxic") >= least) & (F.col("toxic") >= MIN_PRECISION * (F.col("toxic") + F.col("clean"))))
        rows = [tuple(r) for r in often.collect()]
    terms = lexicon(rows, toxic, clean, tried)
    automaton = build(terms, misleading(sample, spark.sparkContext.broadcast(build(terms))))
    texts_of = {(t, stem): (k, m) for t, stem, k, m in rows}
    automaton.strong = [texts_of[t][0] >= STRONG * (sum(texts_of[t]) + 1) for t in terms]
    sent = spark.sparkContext.broadcast(automaton)
    names = [f"x{k}" for k in range(FEATURES)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            x = features(sent.value, batch.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(1), *(pa.array(x[:, k]) for k in range(FEATURES))], ["toxic", *names])

    kind = sample.select("toxic").schema[0].dataType.simpleString()
    seen = sample.select("text", "toxic").mapInArrow(run, f"toxic {kind}, " + ", ".join(f"{c} double" for c in names))
    table = seen.groupBy("toxic", *names).agg(F.count("*").alias("n")).collect()  # at most the sample's rows
    x = np.array([[r[c] for c in names] for r in table for _ in range(r["n"])]).reshape(-1, FEATURES)
    y = np.array([r["toxic"] for r in table for _ in range(r["n"])], float)
    order = np.lexsort((*x.T, y))
    return Model(automaton, regression(x[order], y[order]), terms)


def score(
    docs: DataFrame,
    labels: DataFrame,
    training: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = 0.7,
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """``docs`` with ``score`` and ``predicted`` (1 if the score reaches ``threshold``); columns of these names are replaced.

    ``labels`` has ``doc_id`` and ``toxic``; ``training`` picks its rows to learn from. Repeated labels of a document
    count as toxic if one does; labels that are neither 0 nor 1 are left out, and labels of unknown documents have no effect.
    Null and empty texts get the score of a text without hits; without toxic labels all do. An empty table gives no rows.
    """
    model = fit(docs, labels, training, id_col, text_col, sample_rows)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    docs = docs.drop("score", "predicted")
    names = docs.columns
    at = names.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            found = scores(sent.value, batch.column(at).fill_null("").to_pylist())
            predicted = (found >= threshold).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found), pa.array(predicted)], [*names, "score", "predicted"])

    return docs.mapInArrow(run, StructType(docs.schema.fields[:]).add("score", "double").add("predicted", "integer"))
