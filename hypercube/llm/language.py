"""Language identification with hyperdimensional profiles (operator 6)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hypercube.llm.common import give_back, table

#: Length of the vectors and of the letter n-grams.
DIM, GRAM = 1024, 3
#: About so many labelled documents of each language are learned from, chosen by a hash of doc_id.
SAMPLE = 2000
UNDETERMINED = "und"
#: Code points of a text, and of a batch of texts, that are profiled at a time; n-grams multiplied,
#: and texts judged where only their languages are asked for, at a time.
SLICE, CHARS, GRAMS, TEXTS = 1 << 20, 1 << 19, 4096, 256
#: A normalised profile is bundled as integers of this scale, so that sums don't depend on their order.
SCALE = 1 << 20

_fold: np.ndarray | None = None
_letters: dict[int, np.ndarray] = {}


def _folded(text: str) -> np.ndarray:
    """Lower-cased letters as code points; each run of other characters, and both ends, as one 0."""
    global _fold
    if _fold is None:
        _fold = np.array([ord(c.lower()[0]) if (c := chr(i)).isalpha() else 0 for i in range(0x110000)], np.uint32)
    symbols = np.concatenate([[0], _fold[np.frombuffer(text.encode("utf-32-le"), "<u4")], [0]])
    other = symbols == 0
    return symbols[~(other & np.concatenate([[False], other[:-1]]))]


def _letter(code: int) -> np.ndarray:
    """The random vector of +1 and -1 that stands for a letter."""
    if code not in _letters:
        if len(_letters) >= 1 << 14:
            _letters.clear()
        _letters[code] = np.random.default_rng(code).integers(0, 2, DIM, dtype=np.int8) * 2 - 1
    return _letters[code]


def _bundle(slices: list[np.ndarray], owner: list[int], out: np.ndarray) -> None:
    """Adds each slice's n-gram vectors to its owner's row of ``out``.

    An n-gram's vector binds (multiplies) its letters' vectors, each permuted
    (rolled) by its distance from the end.
    """
    symbols = np.concatenate(slices)
    of = np.repeat(np.arange(len(slices)), [len(s) for s in slices])
    alphabet, place = np.unique(symbols, return_inverse=True)
    vectors = np.stack([_letter(int(c)) for c in alphabet])
    last = len(symbols) - GRAM + 1
    if last <= 0:
        return
    code = np.zeros(last, np.int64)
    for k in range(GRAM):
        code = code * len(alphabet) + place[k: last + k]
    inside = of[:last] == of[GRAM - 1:]
    code, of = code[inside], of[:last][inside]
    if len(alphabet) ** GRAM <= 1 << 22:
        seen = np.zeros(len(alphabet) ** GRAM, bool)
        seen[code] = True
        grams = np.flatnonzero(seen)
        at = np.cumsum(seen)[code] - 1
    else:
        grams, at = np.unique(code, return_inverse=True)
    rolled = [np.roll(vectors, GRAM - 1 - k, axis=1) for k in range(GRAM)]
    sums = np.zeros((len(slices), DIM), np.float32)
    for start in range(0, len(grams), GRAMS):
        some = grams[start: start + GRAMS]
        bound = None
        for k in reversed(range(GRAM)):
            some, letter = np.divmod(some, len(alphabet))
            bound = rolled[k][letter] if bound is None else bound * rolled[k][letter]
        here = slice(None) if len(grams) <= GRAMS else (at >= start) & (at < start + GRAMS)
        counts = np.bincount(of[here] * len(bound) + at[here] - start, minlength=len(slices) * len(bound))
        sums += counts.reshape(len(slices), -1).astype(np.float32) @ bound.astype(np.float32)
    np.add.at(out, owner, sums)


def profiles(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Profile vectors of the texts, and which of them hold a letter."""
    out, known = np.zeros((len(texts), DIM), np.float32), np.zeros(len(texts), bool)
    slices: list[np.ndarray] = []
    owner: list[int] = []
    held = 0
    for n, text in enumerate(texts):
        for start in range(0, len(text or ""), SLICE):
            symbols = _folded(text[start: start + SLICE])
            if symbols.any():
                known[n] = True
                slices.append(symbols)
                owner.append(n)
                held += len(symbols)
            if held >= CHARS or len(slices) >= 256:
                _bundle(slices, owner, out)
                slices, owner, held = [], [], 0
    if slices:
        _bundle(slices, owner, out)
    return out, known


def _unit(vectors: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(vectors, axis=1, keepdims=True)
    return vectors / np.where(norm == 0, 1, norm)


def held_out(doc_id: Column) -> Column:
    """Whether the CRC-32 of doc_id as text leaves 1 on division by 3; false for null."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def learn(labelled: DataFrame, sample: int = SAMPLE) -> dict[str, np.ndarray]:
    """A prototype per language: the sum of normalised profiles of its documents.

    ``labelled`` has doc_id, text and lang.  Languages with more than
    ``sample`` documents are learned from those whose doc_id hashes into the
    share that holds ``sample`` on average.  Partial sums, one per language
    and each of at most 32 tasks, are added on the driver.
    """
    counts = labelled.groupBy("lang").count().collect()
    if not counts:
        return {}
    share = F.create_map(*[F.lit(x) for r in counts for x in (r["lang"], min(1.0, sample / r["count"]))])
    chosen = labelled.filter(F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 30)) < share[F.col("lang")] * (1 << 30))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            vectors, known = profiles(batch.column(0).to_pylist())
            whole = np.rint(_unit(vectors.astype(np.float64)) * SCALE).astype(np.int64)
            langs = np.array(batch.column(1).to_pylist(), object)
            for lang in set(langs[known]):
                sums[lang] = sums.get(lang, 0) + whole[known & (langs == lang)].sum(axis=0)
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums)), pa.array([v.tolist() for v in sums.values()], pa.list_(pa.int64()))],
                                             ["lang", "v"])

    model: dict[str, np.ndarray] = {}
    for row in chosen.select("text", "lang").repartition(32).mapInArrow(run, "lang string, v array<long>").collect():
        model[row["lang"]] = model.get(row["lang"], 0) + np.array(row["v"], np.int64)
    return dict(sorted(model.items()))


def _judge(texts: list[str | None], model: dict[str, np.ndarray], some: int | None = None) -> tuple[list[str], np.ndarray]:
    """The nearest prototype of each text by cosine, and the cosine; ``some`` texts at a time, else all at once.

    The cosine's last digits may follow the number of texts that are multiplied at once.
    """
    names = list(model)
    if not names:
        return [UNDETERMINED] * len(texts), np.zeros(len(texts))
    prototypes = _unit(np.stack(list(model.values())).astype(np.float64)).astype(np.float32)
    langs: list[str] = []
    scores = np.zeros(len(texts))
    some = some or max(1, len(texts))
    for start in range(0, len(texts), some):
        vectors, known = profiles(texts[start: start + some])
        cosine = _unit(vectors) @ prototypes.T
        langs += [names[b] if k else UNDETERMINED for b, k in zip(cosine.argmax(axis=1), known)]
        scores[start: start + some] = np.where(known, np.clip(cosine.max(axis=1), 0, 1), 0)
    return langs, scores


def predict(docs: DataFrame, model: dict[str, np.ndarray]) -> DataFrame:
    """``(doc_id, lang_pred, score)`` per row of ``docs``: the nearest prototype by cosine.

    Texts that are null or hold no letter, and all texts if nothing was
    learned, get ``und`` with score 0.  The score is the cosine, not below 0.
    Equally near languages: the first by name.  Whole texts are read, in
    slices of ``SLICE`` code points.  No rows give no rows.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, scores = _judge(batch.column(1).to_pylist(), model)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(langs, pa.string()), pa.array(scores)],
                                             ["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, lang_pred string, score double")


def _usable(docs: DataFrame) -> DataFrame:
    """The labelled documents that may be learned from."""
    return docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull()
                       & ~held_out(F.col("doc_id"))).select("doc_id", "text", "lang")


def identify(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Learns from the documents that aren't held out and predicts all of them."""
    return predict(docs, learn(_usable(docs), sample))


def keep_identified(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``docs`` without the rows whose language stays undetermined, all columns kept.

    Those are texts that are null or hold no letter.  Where nothing could be
    learned (no labelled text) no language is known and every row stays.
    """
    model = learn(_usable(docs), sample)
    if not model:
        return docs
    text = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known = [lang != UNDETERMINED for start in range(0, len(batch), TEXTS)
                     for lang in _judge(batch.column(text).slice(start, TEXTS).to_pylist(), model)[0]]
            yield batch.filter(pa.array(known, pa.bool_()))
            give_back()

    return docs.mapInArrow(run, docs.schema)


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query: the predicted language of every document."""
    found = identify(table(spark, sf_dir, "documents"))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
