"""Language identification by prediction by partial matching over bytes.

For each language a byte context tree up to three bytes deep is counted on a bounded sample of labelled texts
and then frozen. The code length of a byte is that of its longest known context, with the
escape of each context that has not seen it (method C: a new byte gets the share of as many
counts as the context has distinct bytes). The language with the shortest code for the whole text wins.

As the counts are frozen, all code lengths are known before the first text is scored: they
make one table with a row for each context and byte and a column for each language, sent to the tasks.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from souk.llm.arrays import pieces
from souk.llm.names import others

ORDER = 3
#: About so many bytes of text of each language are learned from, whatever the size of the input.
SAMPLE_BYTES = 400_000
#: Texts are scored in slices of about so many bytes.
SCORED_BYTES = 1 << 19
#: Stands between texts, so that each begins in the same context.
GAP = b"   "
LETTER = regex.compile(r"\p{L}")
UNKNOWN = "und"
#: The columns of a prediction.
ADDED = ("lang_pred", "score", "bits_per_byte")


@dataclass
class Model:
    """``symbols``: the code of each byte; ``contexts``: the row of each three-byte context; ``bits`` by row and code."""

    languages: list[str]
    symbols: np.ndarray
    contexts: np.ndarray
    bits: np.ndarray


def fit(texts: dict[str, list[str]]) -> Model:
    """Context trees of the languages' texts. No languages give a model without columns."""
    languages = sorted(texts)
    streams = [np.frombuffer(GAP + b"".join(t.lower().encode() + GAP for t in texts[lang]), np.uint8) for lang in languages]
    seen = np.unique(np.concatenate([*streams, np.frombuffer(GAP, np.uint8)]))
    symbols = np.full(256, len(seen), np.int64)  # the last code: any byte never seen
    symbols[seen] = np.arange(len(seen))
    size = len(seen) + 1
    streams = [symbols[s] for s in streams]
    n = len(languages)
    # order 0, on top of all bytes alike
    rows = np.full((1, size, n), 8.0)
    ids = np.zeros(1, np.int64)  # context key of the order before -> row
    all_rows = []
    for order in range(ORDER + 1):
        keys = [_keys(s, order, size) for s in streams]
        known = np.unique(np.concatenate([k for k in keys] or [np.zeros(0, np.int64)]) // size) if order else np.zeros(1, np.int64)
        parents = ids[known % max(1, size ** max(0, order - 1))] if order else np.zeros(1, np.int64)
        level = rows[parents]
        for j, k in enumerate(keys):
            pairs, counts = np.unique(k, return_counts=True)
            at = np.searchsorted(known, pairs // size)
            total = np.bincount(at, counts, len(known))
            kinds = np.bincount(at, minlength=len(known))
            held = total > 0
            level[held, :, j] += np.log2((total + kinds)[held] / kinds[held])[:, None]
            level[at, pairs % size, j] = np.log2(total[at] + kinds[at]) - np.log2(counts)
        # a context unknown to all languages stands in the row of its own last bytes
        base = sum(len(r) for r in all_rows)
        keep = np.arange(size**order) % max(1, size ** max(0, order - 1))
        new = ids[keep] if order else np.zeros(1, np.int64)
        lookup = np.arange(len(new)) if not order else new.copy()
        lookup[known] = base + np.arange(len(known))
        all_rows.append(level)
        ids, rows = lookup, np.concatenate(all_rows)
    return Model(languages, symbols, ids.astype(np.int32), rows.reshape(rows.shape[0] * size, n).astype(np.float32))


def _keys(stream: np.ndarray, order: int, size: int) -> np.ndarray:
    """Context of ``order`` codes and the code after it, as one number, at each place after the first gap."""
    out = np.zeros(max(0, len(stream) - ORDER), np.int64)
    for back in range(order, -1, -1):
        out = out * size + stream[ORDER - back : len(stream) - back]
    return out


def code_lengths(model: Model, texts: list[str]) -> np.ndarray:
    """Bits of each text under each language."""
    parts = [t.lower().encode() for t in texts]
    data = model.symbols[np.frombuffer(GAP + b"".join(p + GAP for p in parts), np.uint8)]
    size = round(len(model.contexts) ** (1 / ORDER))
    a, b, c, sym = data[:-3], data[1:-2], data[2:-1], data[3:]
    bits = model.bits[model.contexts[(a * size + b) * size + c].astype(np.int64) * size + sym]
    lengths = np.array([len(p) for p in parts], np.int64)
    starts = np.cumsum(lengths + len(GAP)) - lengths - len(GAP)
    bounds = np.column_stack((starts, starts + lengths)).ravel()
    sums = np.add.reduceat(bits, np.minimum(bounds, len(bits) - 1), axis=0, dtype=np.float64)[::2]
    sums[lengths == 0] = 0
    return sums


def sample(docs: DataFrame, id_col: str, text_col: str, lang_col: str, sample_bytes: int) -> dict[str, list[str]]:
    """About ``sample_bytes`` of text of each language, by a hash of the id."""
    labelled = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    share = labelled.groupBy(F.col(lang_col).alias("_lang")).agg(
        F.least(F.lit(1.0), sample_bytes / F.sum(F.octet_length(text_col).cast("double") + 1)).alias("_share")
    )
    shares = {r["_lang"]: r["_share"] for r in share.collect()}
    if not shares:
        return {}
    limit = F.create_map(*[F.lit(x) for kv in shares.items() for x in kv])[F.col(lang_col)]
    place = F.pmod(F.xxhash64(F.col(id_col).cast("string"), F.lit("language")), F.lit(1 << 20)) / float(1 << 20)
    out: dict[str, list[str]] = {}
    for row in labelled.where(place < limit).select(F.col(lang_col), F.col(text_col)).toLocalIterator():
        out.setdefault(row[0], []).append(row[1])
    return {lang: sorted(texts) for lang, texts in out.items()}


def classify(
    docs: DataFrame,
    training: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    sample_bytes: int = SAMPLE_BYTES,
) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``bits_per_byte`` (columns of these names are replaced), learned from the rows of ``training`` with a language.

    ``score`` is the probability of the language among those learned, all alike beforehand. A text that is
    null or has no letter is ``und`` with score 0; so are all texts if nothing could be learned. Equal codes go to the
    first language in the alphabet. Each row is predicted by its text alone; an empty table gives no rows.
    """
    spark = docs.sparkSession
    docs = docs.select(*others(docs.columns, ADDED))
    model = fit(sample(docs.where(training), id_col, text_col, lang_col, sample_bytes))
    sent = spark.sparkContext.broadcast(model)
    names = docs.columns
    at = names.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = sent.value
        for batch in pieces(batches):
            texts = batch.column(at).to_pylist()
            n = len(texts)
            pred = np.full(n, UNKNOWN, object)
            score, rate = np.zeros(n), np.zeros(n)
            scored = [i for i, t in enumerate(texts) if t and held.languages and LETTER.search(t)]
            begin = 0
            while begin < len(scored):
                end, size = begin, 0
                while end < len(scored) and (end == begin or size + len(texts[scored[end]]) <= SCORED_BYTES):
                    size += len(texts[scored[end]])
                    end += 1
                rows = scored[begin:end]
                bits = code_lengths(held, [texts[i] for i in rows])
                best = bits.argmin(axis=1)
                least = bits.min(axis=1)
                score[rows] = 1 / np.exp2(-np.minimum(bits - least[:, None], 1000)).sum(axis=1)
                pred[rows] = np.array(held.languages, object)[best]
                rate[rows] = least / np.array([len(texts[i].encode()) for i in rows])
                begin = end
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(pred.tolist(), pa.string()), pa.array(score), pa.array(rate)],
                [*names, *ADDED],
            )

    schema = StructType(docs.schema.fields[:]).add("lang_pred", "string").add("score", "double").add("bits_per_byte", "double")
    return docs.mapInArrow(run, schema)
