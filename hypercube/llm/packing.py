"""Lexical retrieval packing with a sharded BM25 index (operator 5)."""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hypercube.llm.common import give_back, table, written

WINDOW = 2048
#: Id that ends each document.
END = 1
#: Tokens of a shard, about.
SHARD = 1 << 21
#: Neighbours that a seed is given at a time, and twice as many each further time.
NEIGHBOURS = 32
#: A term is frequent in a shard if at least one in so many of its documents holds it.
OFTEN = 8
#: Parameters of BM25.
K1, B = 1.2, 0.75
#: Parts of words whose ids a worker remembers, about, and their bytes; code points of texts that are encoded at a time.
REMEMBER, REMEMBER_BYTES, CHARS = 1 << 20, 1 << 26, 1 << 24
#: Texts whose ids are put together at a time.
TOGETHER = 256

#: A text on which a tokenizer that splits between words gives the ids of its words.
SAMPLE = "Some words, 12 more.\n  It's the l'\u00c9cole's LAST;  line-end "

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


# ------------------------------------------------------------------ tokens
#: Words of ASCII without capitals and apostrophes and of lower-case Latin letters, and the parts that the
#: tokenizer splits them into: letters, single digits, marks.
_PLAIN = "^[a-z0-9\u00df-\u00f6\u00f8-\u00ff!-&(-/:-@\\[-`{-~]+$"
_PART = "([a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]|[!-&(-/:-@\\[-`{-~]+)"


#: Code points from 256 on; the lower case of those below is sure to be the tokenizer's.
_BEYOND = r"[^\x{00}-\x{ff}]"


def _lowered(texts: pa.Array) -> pa.Array:
    """The texts, in lower case if all their code points are below 256."""
    beyond = pc.match_substring_regex(texts, _BEYOND)
    lower = pc.utf8_lower(texts)
    if pc.any(beyond).as_py():
        lower = pc.if_else(beyond, texts, lower)
    pa.default_memory_pool().release_unused()
    return lower


def _split(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """What stands between the blanks of the texts: each word once, the words' places in that, where each text's begin."""
    lists = pc.split_pattern(texts, " ")
    del texts
    pa.default_memory_pool().release_unused()
    words, firsts = lists.flatten().dictionary_encode(), lists.offsets.to_numpy() - lists.offsets[0].as_py()
    del lists
    pa.default_memory_pool().release_unused()
    return words.dictionary, words.indices.to_numpy(), firsts


class _Spans:
    """Rows of ids, one after the other."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray):
        self.ids, self.lengths = ids, lengths
        self.ends = np.cumsum(lengths, dtype=np.int64)

    def take(self, at: np.ndarray) -> _Spans:
        """The rows at the given places."""
        lengths = self.lengths[at]
        before = np.repeat((self.ends[at] - np.cumsum(lengths, dtype=np.int64)).astype(np.int32), lengths)
        before += np.arange(len(before), dtype=np.int32)
        return _Spans(self.ids[before], lengths)

    def joined(self, firsts: np.ndarray) -> _Spans:
        """The rows from each of ``firsts`` up to the next as one; the last one ends the last."""
        ends = np.concatenate([[0], self.ends])[firsts]
        return _Spans(self.ids, np.diff(ends).astype(np.int32))


class Encoder:
    """The tokenizer's ids of whole texts, by the distinct parts of their words.

    It splits at white space and at the edges of words before anything else,
    so the ids of a text are those of what stands between its blanks and line
    feeds.  Plain words in lower case need no more than the tokenizer's model.
    Texts that name a special token, and all texts if a sample shows that the
    tokenizer is of another kind, are encoded in one go.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.bytes_of: dict[str, str] = {}
        self._forget()
        self.by_word = True
        self.by_word = self(SAMPLE) == self._encode(SAMPLE)

    def _forget(self) -> None:
        self.known, self.ids = pa.array([], pa.string()), _Spans(np.zeros(0, "<u4"), np.zeros(0, np.int32))

    def _encode(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _spelled(self, letter: str) -> str:
        """How the tokenizer writes a letter's bytes."""
        if letter not in self.bytes_of:
            self.bytes_of[letter] = "".join(part for part, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(letter))
        return self.bytes_of[letter]

    def _part(self, part: str, plain: bool) -> list[int]:
        """Ids of a part of a word; of one in plain letters by the model alone."""
        if not plain or not part.isalpha():
            return self.tokenizer.encode(part, add_special_tokens=False).ids
        spelled = part if part.isascii() else "".join(map(self._spelled, part))
        return [t.id for t in self.model.tokenize(spelled)]

    def _parts(self, parts: pa.Array) -> _Spans:
        """Ids of distinct parts of words.

        They are remembered; when there are too many, only these are kept."""
        at = pc.index_in(parts, value_set=self.known)
        new = parts.filter(at.is_null())
        if len(new) and (len(self.known) + len(new) > REMEMBER or self.known.nbytes + new.nbytes > REMEMBER_BYTES):
            self._forget()
            at, new = pa.nulls(len(parts), pa.int32()), parts
        at = at.fill_null(-1).to_numpy(zero_copy_only=False).copy()
        at[at < 0] = np.arange(len(self.known), len(self.known) + len(new))
        if len(new):
            found = list(map(self._part, new.to_pylist(), pc.match_substring_regex(new, _PLAIN).to_pylist()))
            self.known = pa.concat_arrays([self.known, new])
            self.ids = _Spans(np.concatenate([self.ids.ids, np.fromiter(chain.from_iterable(found), "<u4")]),
                              np.concatenate([self.ids.lengths, np.fromiter(map(len, found), np.int32, len(found))]))
        return self.ids.take(at)

    def _words(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """Ids of each text, none of which names a special token; put together for some texts at a time."""
        # no copy of the texts outlives its use
        words, place, firsts = _split(pc.replace_substring(_lowered(texts), "\n", " "))
        apart = pc.replace_substring_regex(words, _PART, r"\1 ")
        parts, part, first = _split(pc.if_else(pc.match_substring_regex(words, _PLAIN), apart, words))
        of_word = self._parts(parts).take(part).joined(first)
        for at in range(0, len(texts), TOGETHER):
            ends = firsts[at: at + TOGETHER + 1]
            found = of_word.take(place[ends[0]: ends[-1]]).joined(ends - ends[0])
            yield from np.split(found.ids, found.ends[:-1])

    def batch(self, texts: list[str]) -> Iterator[np.ndarray]:
        """The ids of each text, by about ``CHARS`` code points at a time."""
        start = 0
        while start < len(texts):
            end, held = start, 0
            while end < len(texts) and (end == start or held + len(texts[end]) <= CHARS):
                held, end = held + len(texts[end]), end + 1
            yield from self.array(pa.array(texts[start: end], pa.string()))
            start = end

    def array(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text, all at once."""
        whole = np.full(len(texts), not self.by_word)
        for s in self.special:
            whole |= pc.match_substring(texts, s).to_numpy(zero_copy_only=False)
        found = self._words(pc.if_else(pa.array(whole), "", texts) if whole.any() else texts)
        for n, ids in enumerate(found):
            yield np.frombuffer(self._encode(texts[n].as_py()), "<u4") if whole[n] else ids

    def __call__(self, text: str) -> bytes:
        return next(self.batch([text])).tobytes()


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


# ------------------------------------------------- statistics and shards
#: Kind of the numbers that count a document's terms.
COUNT = "<u4"


def _counted(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ids in order and how often each occurs."""
    ids = np.sort(ids)
    begins = np.ones(len(ids), bool)
    np.not_equal(ids[1:], ids[:-1], out=begins[1:])
    at = np.flatnonzero(begins)
    return ids[at], np.append(at[1:], len(ids)) - at


def _told(terms: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """How much each term tells about a document."""
    return idf[terms] * (counts * (K1 + 1) / (counts + K1))


def _topics(terms: np.ndarray, counts: np.ndarray, lengths: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """The term that tells most about each document, -1 if it has none; documents follow each other, ``lengths`` count their terms."""
    told, some = _told(terms, counts, idf), lengths > 0
    found = np.full(len(lengths), -1)
    if some.any():
        begins = (np.cumsum(lengths) - lengths)[some]
        best = np.flatnonzero(told == np.repeat(np.maximum.reduceat(told, begins), lengths[some]))
        found[some] = terms[best[np.searchsorted(best, begins)]]
    return found


def _topic(terms: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> int:
    """The term that tells most about a document, -1 if it has none."""
    return int(_topics(terms, counts, np.array([len(terms)]), idf)[0])


def _topics_of(terms: pa.Array, counts: pa.Array, kind: str, idf: np.ndarray) -> np.ndarray:
    """``_topics`` of a column of terms and one of their counts."""
    terms = terms.to_pylist()
    return _topics(np.frombuffer(b"".join(terms), kind), np.frombuffer(b"".join(counts.to_pylist()), COUNT),
                   np.array([len(x) for x in terms], np.int64) // np.dtype(kind).itemsize, idf)


def _key(terms: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> bytes:
    """All terms, those that tell most first, as bytes in whose order documents with the same first terms are neighbours."""
    order = np.argsort(-_told(terms, counts, idf), kind="stable")
    return terms[order].astype(terms.dtype.newbyteorder(">")).tobytes()


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch's rows, by about ``CHARS`` code points of the second column at a time."""
    ends = np.cumsum(pc.utf8_length(batch.column(1)).fill_null(0).to_numpy(), dtype=np.int64)
    start = 0
    while start < len(ends):
        end = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + CHARS, "right")))
        yield batch.slice(start, end - start)
        start = end


def tokenize(docs: DataFrame, path: str, kind: str, size: int) -> DataFrame:
    """Each row of ``docs`` as ``(doc_id, ids, terms, counts, same, n, slot)``, and each task's document frequencies as ``(term, n)``.

    ids are those of the text, as numbers of the given kind; terms are the
    distinct ones in order, counts how often each occurs, same their hash; n
    counts the ids and the end id; slot numbers a task's rows.  A task sends
    one row for each term of the vocabulary at most.
    """
    names = ["doc_id", "ids", "terms", "counts", "same", "n", "slot", "term"]
    types = [pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(*columns):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

        encode, frequency, slot = encoder(path), np.zeros(size, np.int64), 0
        for batch in (part for whole in batches for part in _slices(whole)):
            texts = encode.array(batch.column(1).cast(pa.string()).fill_null(""))
            for at in range(0, len(batch), TOGETHER):
                doc_ids, found = batch.column(0).slice(at, TOGETHER), [[], [], [], [], []]
                for ids in islice(texts, len(doc_ids)):
                    terms, counts = _counted(ids.astype(kind))
                    frequency[terms] += 1
                    ids = ids.astype(kind).tobytes()
                    for column, x in zip(found, (ids, terms.tobytes(), counts.astype(COUNT).tobytes(), zlib.crc32(ids), counts.sum() + 1)):
                        column.append(x)
                yield rows(doc_ids, *found, range(slot, slot + len(doc_ids)), [None] * len(doc_ids))
                slot += len(doc_ids)
            # a slice's words are much larger than what stays of it, and other tasks follow in this worker
            del texts
            give_back()
        at = np.flatnonzero(frequency)
        none = [None] * len(at)
        yield rows(none, none, none, none, none, frequency[at], none, at)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, ids binary, terms binary, counts binary, same long, n long, slot long, term long")


def _deal(tokens: dict[int, int], shard: int) -> list[tuple[int, int, int]]:
    """``(topic, first shard, number of shards)`` for every topic.

    Small topics fill a shard together, in order; one with more than a
    shard's tokens needs several (``_cuts``).
    """
    out = []
    at, filled = 0, 0
    for topic, n in sorted(tokens.items()):
        if n > shard:
            at, filled = at + (filled > 0), 0
            out.append((topic, at, -(-n // shard)))
            at += out[-1][2]
            continue
        if filled + n > shard:
            at, filled = at + 1, 0
        out.append((topic, at, 1))
        filled += n
    return out


def _alike(a: bytes, b: bytes, width: int) -> int:
    """How many terms two keys begin with in common."""
    n = min(len(a), len(b)) // width * width
    if a[:n] == b[:n]:
        return n // width
    return int((np.frombuffer(a[:n], np.uint8) != np.frombuffer(b[:n], np.uint8)).argmax()) // width


#: Below the end of every text's hash, and of every row's.
_LEAST = -1 << 63


def _segments(rows: Iterator[tuple], shard: int, width: int) -> Iterator[tuple]:
    """``(key, same, tie, n, starts)`` for segments of at most ``shard`` tokens of the sorted rows ``(key, same, tie, n)``.

    A segment begins at the given place in the order and ends with its topic,
    or in its second half where neighbours have the fewest first terms in
    common, so that what is most alike stays together.  Only equal texts are
    cut by their rows' hashes.  ``starts`` marks the first segment.
    """
    held: list[tuple[int, int, tuple]] = []
    total, before, starts = 0, None, True
    for key, same, tie, n in rows:
        if before is None:
            alike, place = 0, (key, same, tie)
        elif key != before[0]:
            alike = _alike(key, before[0], width)
            place = (key[: (alike + 1) * width], _LEAST, _LEAST)
        else:
            alike = len(key) // width + 1 + (same == before[1])
            place = (key, same, tie if same == before[1] else _LEAST)
        before = key, same
        if held and not alike:
            yield (*held[0][2], total, starts)
            held, total, starts = [], 0, False
        while held and total + n > shard:
            at, first, least = 0, 0, None
            for k, (m, _, _) in enumerate(held, 1):
                at += m
                here = held[k][1] if k < len(held) else alike
                if (2 * at >= shard or k == len(held)) and (least is None or here <= least):
                    first, least, tokens = k, here, at
            yield (*held[0][2], tokens, starts)
            held, total, starts = held[first:], total - tokens, False
        held.append((n, alike, place))
        total += n
    if held:
        yield (*held[0][2], total, starts)


def _joined(segments: list[tuple], shard: int, width: int) -> list[tuple]:
    """Where shards begin but for the first, if tasks' segments follow each other: a task's first one may go on with the last task's."""
    out, filled, topic = [], 0, None
    for key, same, tie, n, starts in sorted(segments):
        if topic is not None and (not starts or filled + n > shard or key[:width] != topic):
            out.append((key, same, tie))
            filled = 0
        filled, topic = filled + n, key[:width]
    return out


def _cuts(own: DataFrame, kind: str, idf: np.ndarray, large: dict[int, int], shard: int) -> list[tuple]:
    """Where the shards of the documents of ``large`` topics begin, but for the first, in the order of ``(key, same, tie)``.

    Documents are ordered by all their terms, those that tell most first,
    equal ones by a hash of the row.  The driver gets a place for each shard
    and task.
    """
    width = np.dtype(kind).itemsize

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.flatnonzero(np.isin(_topics_of(batch.column(0), batch.column(1), kind, idf), list(large)))
            kept = batch.take(pa.array(at))
            found = [_key(np.frombuffer(terms, kind), np.frombuffer(counts, COUNT), idf)
                     for terms, counts in zip(kept.column(0).to_pylist(), kept.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary()), *kept.columns[2:]], ["key", "same", "tie", "n"])

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for batch in batches for r in zip(*(c.to_pylist() for c in batch.columns)))
        if found := list(_segments(rows, shard, width)):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), (pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.bool_()))],
                                             ["key", "same", "tie", "n", "starts"])

    kind_of = "key binary, same long, tie long, n long"
    keyed = written(own.select("terms", "counts", "same", "tie", "n").mapInArrow(keys, kind_of), "keys")
    order = ["key", "same", "tie"]
    # some shards for each task, so that few begin at a task's first row
    found = (keyed.repartitionByRange(-(-sum(large.values()) // (8 * shard)), *order).sortWithinPartitions(*order)
             .mapInArrow(segments, kind_of + ", starts boolean").collect())
    return _joined([(bytes(r["key"]), r["same"], r["tie"], r["n"], r["starts"]) for r in found], shard, width)


def sharded(rows: DataFrame, kind: str, size: int, shard: int) -> tuple[DataFrame, np.ndarray, float]:
    """``(shard, doc_id, ids)`` of the rows of ``tokenize``, the terms' idf, and the documents' mean length.

    A document goes to the shard of its topic, the term that tells most about
    it over all documents.  Topics of more than a shard's tokens are split by
    their documents' next terms, down to equal texts.
    """
    own = rows.filter("term IS NULL").withColumn("tie", F.xxhash64("doc_id", "slot"))
    # one row per term of the vocabulary: that bounds what the driver gets
    frequency, n, tokens = np.zeros(size), 0, 0
    for r in rows.groupBy("term").agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("n")).collect():
        if r["term"] is None:
            n, tokens = r["docs"], r["n"] - r["docs"]
        else:
            frequency[r["term"]] = r["n"]
    mean = max(1.0, tokens / max(1, n))
    idf = np.log1p((n - frequency + 0.5) / (frequency + 0.5))

    def topics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(size + 1, np.int64)
        for batch in batches:
            np.add.at(sums, _topics_of(batch.column(0), batch.column(1), kind, idf) + 1, batch.column(2).to_numpy())
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at - 1), pa.array(sums[at])], ["topic", "n"])

    dealt = _deal({r["topic"]: r["n"] for r in own.select("terms", "counts", "n").mapInArrow(topics, "topic long, n long")
                   .groupBy("topic").agg(F.sum("n").alias("n")).collect()}, shard)
    of = np.full(size + 1, -1)
    for topic, first, parts in dealt:
        if parts == 1:
            of[topic + 1] = first
    sums = {topic: parts * shard for topic, _, parts in dealt if parts > 1}
    cuts = _cuts(own, kind, idf, sums, shard) if sums else []
    after = max((first + parts for _, first, parts in dealt), default=0)

    @F.arrow_udf("long")
    def to_shard(terms: pa.Array, counts: pa.Array, same: pa.Array, tie: pa.Array) -> pa.Array:
        shards = of[_topics_of(terms, counts, kind, idf) + 1]
        for k in np.flatnonzero(shards < 0).tolist():
            key = _key(np.frombuffer(terms[k].as_py(), kind), np.frombuffer(counts[k].as_py(), COUNT), idf)
            shards[k] = after + bisect_right(cuts, (key, same[k].as_py(), tie[k].as_py()))
        return pa.array(shards, pa.int64())

    return own.select(to_shard("terms", "counts", "same", "tie").alias("shard"), "doc_id", "ids"), idf, mean


# ------------------------------------------------------------------ packing
class _Index:
    """BM25 weights of a shard's documents by term: a row of all documents for each frequent term, else the documents that hold it."""

    def __init__(self, docs: list[np.ndarray], idf: np.ndarray, mean: float):
        terms, owners, weights = [], [], []
        for n, ids in enumerate(docs):
            t, c = _counted(ids)
            terms.append(t)
            owners.append(np.full(len(t), n, np.intp))
            weights.append(idf[t] * (c * (K1 + 1) / (c + K1 * (1 - B + B * len(ids) / mean))))
        self.terms = terms
        term = np.concatenate(terms) if terms else np.zeros(0, np.int64)
        order = np.argsort(term, kind="stable")
        term, owner, weight = term[order], np.concatenate(owners)[order], np.concatenate(weights)[order]
        held = np.bincount(term, minlength=len(idf))
        often = held * OFTEN >= max(1, len(docs))
        #: The rows of frequent terms in ``table``, -1 of others.
        self.row = np.where(often, np.cumsum(often) - 1, -1)
        self.table = np.zeros((often.sum(), len(docs)))
        here = often[term]
        self.table[self.row[term[here]], owner[here]] = weight[here]
        self.owner, self.weight = owner[~here], weight[~here]
        self.first = np.concatenate([[0], np.cumsum(np.where(often, 0, held))])
        #: The documents that are still in the index, by their number in it.
        self.place = np.arange(len(docs))

    def keep(self, unused: np.ndarray) -> None:
        """Takes all but the unused documents out, once these are at most four fifths of those in the index."""
        stay = unused[self.place]
        if 5 * stay.sum() > 4 * len(stay):
            return
        number, held = np.cumsum(stay) - 1, stay[self.owner]
        self.first = np.concatenate([[0], np.cumsum(held)])[self.first]
        self.owner, self.weight = number[self.owner[held]], self.weight[held]
        self.table, self.place = self.table.compress(stay, axis=1), self.place[stay]

    def scores(self, doc: int) -> np.ndarray:
        """The score of every document in the index for all terms of ``doc``."""
        terms = self.terms[doc].astype(np.intp)
        rows = self.row[terms]
        scores = np.zeros(len(self.place))
        for row in rows[rows >= 0].tolist():
            scores += self.table[row]
        terms = terms[rows < 0]
        spans = [(a, b) for a, b in zip(self.first[terms].tolist(), self.first[terms + 1].tolist()) if b > a]
        if spans:
            scores += np.bincount(np.concatenate([self.owner[a:b] for a, b in spans]),
                                  np.concatenate([self.weight[a:b] for a, b in spans]), len(self.place))
        return scores


def _best(scores: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` places with the highest scores and those as high as the last, none of score 0 or below, best first."""
    least = np.partition(scores, len(scores) - n)[len(scores) - n] if n < len(scores) else 0
    some = np.flatnonzero((scores >= least) & (scores > 0))
    return some[np.argsort(-scores[some], kind="stable")]


def _ranked(scores: np.ndarray) -> Iterator[int]:
    """All places with scores above 0, best first, ranked a few at a time."""
    n = NEIGHBOURS
    while len(some := _best(scores, n)):
        yield from some.tolist()
        scores[some] = -1
        n *= 2


def fill_windows(docs: list[np.ndarray], lengths: list[int], idf: np.ndarray, mean: float,
                 window: int = WINDOW) -> list[list[tuple[int, int, int]]]:
    """Sequences of ``(document, start, length)``.

    What fills whole windows of a document goes first.  Each window then
    begins with a seed, the document cut last or else the next unused one, and
    takes the unused documents that BM25 ranks highest for it by all its
    terms; the one that no longer fits is cut, and its rest stays unused.
    Only where no unused document shares a term with the seed, the window goes
    on with the next seed.  Of the last window, what isn't full is cut at
    powers of two, which need no padding.
    """
    sequences: list[list[tuple[int, int, int]]] = []
    start = [0] * len(lengths)
    for n, length in enumerate(lengths):
        while length - start[n] >= window:
            sequences.append([(n, start[n], window)])
            start[n] += window
    unused = np.array([length > s for length, s in zip(lengths, start)], bool)
    index = _Index(docs, idf, mean)
    current: list[tuple[int, int, int]] = []
    room, following, seed = window, 0, -1

    def put(n: int) -> None:
        nonlocal current, room, seed
        take = min(room, lengths[n] - start[n])
        current.append((n, start[n], take))
        start[n] += take
        room -= take
        unused[n] = start[n] < lengths[n]
        if not room:
            sequences.append(current)
            current, room = [], window
            seed = n if unused[n] else -1

    left = int(unused.sum())
    while left:
        if seed < 0:
            while not unused[following]:
                following += 1
            seed = following
        of, done = seed, len(sequences)
        put(seed)
        if len(sequences) == done:
            index.keep(unused)
            scores = index.scores(of)
            scores[~unused[index.place]] = -1
            for n in _ranked(scores):
                put(int(index.place[n]))
                if len(sequences) > done:
                    break
            else:
                # nothing unused is like the seed
                seed = -1
        left = int(unused.sum())
    rest = window - room
    while rest:
        size = 1 << (rest.bit_length() - 1)
        part, need = [], size
        while need:
            n, at, length = current.pop(0)
            part.append((n, at, min(length, need)))
            if length > need:
                current.insert(0, (n, at + need, length - need))
            need -= min(length, need)
        sequences.append(part)
        rest -= size
    return sequences


def pack(docs: DataFrame, path: str, window: int = WINDOW, shard: int = SHARD, with_ids: bool = False) -> DataFrame:
    """Pieces of all documents in sequences of at most ``window`` tokens.

    A document is its text's ids and the end id; null and empty texts are just
    the end id.  Every id lies in exactly one piece; repeated rows are
    documents of their own.  Document frequencies and the mean length are
    taken over all documents.  A document goes to the shard of the term that
    tells most about it, so lexical neighbours meet; the documents of a term
    with more of them than fit a shard are split by their next terms
    (``sharded``), so no shard grows with the input.  Only a document longer
    than a shard is larger.  ``with_ids`` adds each piece's ids.  No documents
    give no rows.
    """
    from tokenizers import Tokenizer
    size = Tokenizer.from_file(path).get_vocab_size()
    kind = "<u2" if size <= 1 << 16 else "<u4"
    dealt, idf, mean = sharded(written(tokenize(docs, path, kind, size), "tokens"), kind, size, shard)
    dealt = dealt.select("shard", F.coalesce("doc_id", F.lit(0)).alias("doc_id"), F.col("doc_id").isNull().alias("nameless"), "ids")

    def packed(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["nameless", "doc_id", "ids"], kind="stable").reset_index(drop=True)
        texts = [np.frombuffer(x, kind) for x in pdf["ids"]]
        out = []
        for k, sequence in enumerate(fill_windows(texts, [len(t) + 1 for t in texts], idf, mean, window)):
            offset = 0
            for d, start, length in sequence:
                ids = texts[d][start: start + length].astype("<u4")
                if len(ids) < length:
                    ids = np.append(ids, np.uint32(END)).astype("<u4")
                out.append((d, start, length, zlib.crc32(ids.tobytes()), len(texts[d]) + 1,
                            (int(pdf["shard"].iat[0]) << 32) + k, offset, ids if with_ids else None))
                offset += length
        found = pd.DataFrame(out, columns=["d", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"])
        give_back()
        found.insert(0, "doc_id", pdf["doc_id"].astype(object).where(~pdf["nameless"], None).to_numpy()[found["d"]])
        return found.drop(columns=["d"] if with_ids else ["d", "ids"])

    return dealt.groupBy("shard").applyInPandas(packed, PIECES + (", ids array<long>" if with_ids else ""))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query: where the ids of every document lie."""
    return pack(table(spark, sf_dir, "documents"), tokenizer_path())
