"""A hidden Markov language model over words, trained by Baum-Welch on Spark.

Words: lower-case A-Z, runs without white space, one end token per document. Every
training word has emission probabilities of its own in every state. The most frequent
(``own_words``) and the end token are kept in a bounded table that is broadcast; those of all
others are a written table, aggregated and joined by word, which grows with the corpus.

Base distribution: (c + 0.1) / (N + 0.1 (V + 1)) with all training counts. A word's emission in
a state is its base probability times (E + PRIOR P) / ((c + PRIOR) P), where E of its c tokens are
expected in the state and P is the state's share of all tokens: rare words stay near their base
probability, and an unseen word keeps it. Each state's probabilities are scaled to add up to one with
one unknown word.

Training: start classes come from the co-occurrence of the most frequent words, counted
over all training documents (singular vectors, then k-means). Each Baum-Welch round
reads all training tokens; tasks add up expected counts, an aggregate with a map-side part
adds the tasks', and the driver sees one bounded table (own_words x states); the counts of all
other words stay on the executors. With ``part_each_round`` every round joins the texts with the words' table, so
the result doesn't depend on ``own_words``. Without it, the words beyond the bounded table share their
emissions while rounds go on; once these gain little, a last one reads all training tokens again, adds up every
word's expected counts and gives every word emissions of its own. Then texts are joined with the words' table once, for scoring.

Long texts: sequences are cut into segments of ``SEGMENT`` tokens. Scaled transfer
matrices of all segments are multiplied side by side and chained per document, which
gives the exact forward (and backward) vectors at every cut; inside the
segments the recursions run side by side too. This is the scaled forward recursion, reordered.

Defined results: a null text counts as empty (one end token); repeated rows stay apart (each
row has its own number); an empty training set gives the base distribution; an empty table no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import chain, compress, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, _parse_datatype_string

from ..session import ship_package
from .common import most_frequent, named, slices, written

OWN_WORDS = 1 << 16
STATES = 6
#: Rounds end when one gains less than this log likelihood (natural) a token, or at the limit.
TOLERANCE = 0.05
ROUNDS = 10
START_WORDS = 512
SEGMENT = 64
ADD = 0.1
#: Tokens of each word that are spread over the states like all tokens.
PRIOR = 0.3
#: Emissions of words beyond the bounded table travel as parts of their base probability, in steps of an octave, in 21 bits.
STEPS, OCTAVES, MOST = 1 << 15, 48, (1 << 21) - 1
#: Mean state probabilities of a word's tokens travel as whole numbers up to this.
WHOLE = (1 << 20) - 1


@dataclass
class Model:
    start: np.ndarray  # K
    moves: np.ndarray  # K x K
    emits: np.ndarray  # symbols x K


# ------------------------------------------------------- recursions on a slice


def segments(sizes: np.ndarray, length: int = SEGMENT) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, first token, number of tokens) of each segment, document by document."""
    n = (sizes + length - 1) // length
    doc = np.repeat(np.arange(len(sizes)), n)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
    begin = np.repeat(np.cumsum(sizes) - sizes, n) + nth * length
    return doc, begin, np.minimum(length, np.repeat(sizes, n) - nth * length)


class Slice:
    """Token ids of several documents (every document has an end token), cut up.

    The recursions keep states in rows and segments in columns: a step is one small matrix
    product, and its element-wise work runs along the segments."""

    def __init__(self, ids: np.ndarray, sizes: np.ndarray, model: Model, own: np.ndarray | None = None):
        """``own``: emissions of the tokens with the last symbol, one row for each of them
        (without the silent state); by default the model's for that symbol."""
        self.ids, self.sizes, self.model = ids, sizes, model
        self.doc, self.begin, self.length = segments(sizes)
        # longest segments first: those still running at a step are a leading part
        self.by = np.argsort(-self.length, kind="stable")
        self.longest = int(self.length.max()) if len(self.length) else 0
        self.running = np.searchsorted(-self.length[self.by], -np.arange(self.longest), "left")
        # tokens step by step: the step's part of ``order`` and ``emitted`` starts at ``offset``
        self.offset = np.append(0, np.cumsum(self.running))
        starts = self.begin[self.by]
        self.order = np.concatenate([starts[:r] + t for t, r in enumerate(self.running)]) if self.longest else np.zeros(0, np.int64)
        emitted = model.emits[ids]
        if own is not None:
            emitted[ids == len(model.emits) - 1, 1:] = own
        self.emitted = np.ascontiguousarray(emitted[self.order].T)

    def step(self, t: int) -> tuple[int, np.ndarray]:
        """Number of segments with a token at step ``t``, and the tokens' emissions."""
        return self.running[t], self.emitted[:, self.offset[t] : self.offset[t + 1]]

    def transfers(self) -> tuple[np.ndarray, np.ndarray]:
        """Scaled product of moves and emissions over each segment, and its log scale."""
        forth, k, n = np.ascontiguousarray(self.model.moves.T), len(self.model.start), len(self.by)
        out = np.repeat(np.eye(k, dtype=forth.dtype)[:, :, None], n, axis=2)
        scale = np.zeros(n)
        for t in range(self.longest):
            r, b = self.step(t)
            x = np.matmul(forth, out[:, :, :r])
            x *= b
            if t % 8 == 7 or t == self.longest - 1:
                s = x.max(axis=(0, 1))
                x /= s
                scale[:r] += np.log(s)
            out[:, :, :r] = x
        back = np.empty_like(self.by)
        back[self.by] = np.arange(n)
        return np.ascontiguousarray(out.transpose(2, 0, 1)[back]), scale[back]

    def chain(self, transfers: np.ndarray, scale: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Forward vector (sums to one) before each segment, and each document's
        natural log likelihood. The start distribution is moved back one step: the
        first segment's transfer begins with a move, so it enters through ``entry``."""
        k, n_docs = len(self.model.start), len(self.sizes)
        before = np.zeros((len(self.doc), k))
        log = np.zeros(n_docs)
        vector = np.repeat(self.entry()[None], n_docs, axis=0)
        first = np.searchsorted(self.doc, np.arange(n_docs), "left")
        count = np.bincount(self.doc, minlength=n_docs)
        docs = np.flatnonzero(count > 0)
        nth = 0
        while len(docs):
            at = first[docs] + nth
            before[at] = vector[docs]
            x = np.einsum("nk,nkl->nl", vector[docs], transfers[at])
            s = x.sum(axis=1)
            log[docs] += np.log(s) + scale[at]
            vector[docs] = x / s[:, None]
            nth += 1
            docs = docs[count[docs] > nth]
        return before, log

    def entry(self) -> np.ndarray:
        # state 0 of the extended chain: one row of moves is the start distribution
        return np.eye(len(self.model.start))[0]

    def back(self, transfers: np.ndarray) -> np.ndarray:
        """Backward vector (largest entry one) after each segment."""
        k, n_docs = len(self.model.start), len(self.sizes)
        after = np.ones((len(self.doc), k))
        vector = np.ones((n_docs, k))
        last = np.searchsorted(self.doc, np.arange(n_docs), "right") - 1
        count = np.bincount(self.doc, minlength=n_docs)
        docs = np.flatnonzero(count > 0)
        nth = 0
        while len(docs):
            at = last[docs] - nth
            after[at] = vector[docs]
            x = np.einsum("nkl,nl->nk", transfers[at], vector[docs])
            vector[docs] = x / x.max(axis=1)[:, None]
            nth += 1
            docs = docs[count[docs] > nth]
        return after

    def expected(self) -> tuple[np.ndarray, np.ndarray, float]:
        """Expected moves (K x K), expected emissions (symbols x K), log likelihood; each
        token's state probabilities (K x tokens) are left in ``weights``."""
        m, k = self.model, len(self.model.start)
        transfers, scale = self.transfers()
        before, log = self.chain(transfers, scale)
        after = self.back(transfers)
        forth, ends = np.ascontiguousarray(m.moves.T), self.offset
        # forward vectors up to a factor: after each token, and before each segment
        alpha = np.empty_like(self.emitted)
        begin = last = np.ascontiguousarray(before[self.by].T, dtype=alpha.dtype)
        for t in range(self.longest):
            r, b = self.step(t)
            x = forth @ last[:, :r]
            x *= b
            if t % 8 == 7:
                x /= x.max(axis=0)
            alpha[:, ends[t] : ends[t + 1]] = last = x
        beta = np.ascontiguousarray(after[self.by].T, dtype=alpha.dtype)
        moves, gamma = np.zeros((k, k)), np.empty_like(self.emitted)
        for t in range(self.longest - 1, -1, -1):
            r, b = self.step(t)
            gamma[:, ends[t] : ends[t + 1]] = alpha[:, ends[t] : ends[t + 1]] * beta[:, :r]
            right = b * beta[:, :r]
            pull = m.moves @ right
            earlier = alpha[:, ends[t - 1] : ends[t - 1] + r] if t else begin[:, :r]
            right /= (earlier * pull).sum(axis=0)
            moves += earlier @ right.T
            if t % 8 == 0:
                pull /= pull.max(axis=0)
            beta[:, :r] = pull
        moves *= m.moves
        gamma /= gamma.sum(axis=0)
        self.weights = np.empty_like(gamma)
        self.weights[:, self.order] = gamma
        emits = np.stack([np.bincount(self.ids, w, minlength=len(m.emits)) for w in self.weights], axis=1)
        return moves, emits, float(log.sum())


def extended(model: Model) -> Model:
    """The same chain with a silent first state: its moves are the start
    distribution, it emits nothing and is never entered again."""
    k = len(model.start)
    moves = np.zeros((k + 1, k + 1))
    moves[0, 1:], moves[1:, 1:] = model.start, model.moves
    emits = np.zeros((len(model.emits), k + 1))
    emits[:, 1:] = model.emits
    return Model(np.append(1.0, np.zeros(k)), moves, emits)


def log_likelihoods(ids: np.ndarray, sizes: np.ndarray, model: Model, own: np.ndarray | None = None) -> np.ndarray:
    """Natural log probability of each document's symbols under ``model``."""
    s = Slice(ids, sizes, extended(model), own)
    return s.chain(*s.transfers())[1]


# ------------------------------------------------------------------ on Spark


def tokens_of(text: bytes | None) -> list[bytes]:
    return (text or b"").lower().split()


def count_words(rows: DataFrame) -> DataFrame:
    """Rows (word, c) over the texts of ``rows`` (text): whole texts, all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for _, texts in slices(batches, 0):
            for t in texts:
                seen.update(tokens_of(t))
            if len(seen) > 500_000:
                yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], names=["word", "c"])
                seen.clear()
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], names=["word", "c"])

    return rows.mapInArrow(run, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def _blobs(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """A binary value for each row: the bytes of its part of ``values``."""
    offsets = np.append(0, np.cumsum(sizes * values.itemsize)).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))])


def _unblobbed(column: pa.Array, kind) -> tuple[np.ndarray, np.ndarray]:
    """What ``_blobs`` packed: flat values, and their number in each row."""
    column = column.cast(pa.binary())
    if not len(column):
        return np.zeros(0, kind), np.zeros(0, np.int64)
    ends = np.frombuffer(column.buffers()[1], np.int32, len(column) + 1, column.offset * 4).astype(np.int64)
    values = np.frombuffer(column.buffers()[2], kind, (ends[-1] - ends[0]) // np.dtype(kind).itemsize, ends[0]) if ends[-1] > ends[0] else np.zeros(0, kind)
    return values, np.diff(ends) // np.dtype(kind).itemsize


#: Symbols travel in two bytes. Words' symbols from this on, and the words beyond the bounded table, have this
#: code; the former are listed with their places. A text's last code stands for the end token.
ESCAPE = (1 << 16) - 1


def _numbered(rows: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """Rows (row, doc_id, held_out, ids, exact, others): symbols of each text (see ``ESCAPE``), and
    the words beyond the bounded table, in order, joined by spaces. ``row`` numbers the rows (fixed once written)."""
    rest = len(vocabulary) + 1
    shared = rows.sparkSession.sparkContext.broadcast(vocabulary)
    fields = _parse_datatype_string("row long, doc_id string, held_out boolean, ids binary, exact binary, others binary").fields
    fields[1] = rows.schema["doc_id"]
    schema = StructType(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, number = shared.value, TaskContext.get().partitionId() << 40
        for part, texts in slices(batches, 2):
            words = [tokens_of(t) for t in texts]
            sizes = np.fromiter(map(len, words), np.int64, len(words))
            ends, flat = np.cumsum(sizes), list(chain.from_iterable(words))
            ids = np.fromiter(map(known.get, flat, repeat(rest)), np.int32, len(flat))
            beyond = ids == rest
            upto = np.append(0, np.cumsum(beyond))[np.append(0, ends)].tolist()
            missed = list(compress(flat, beyond.tolist()))
            others = [b" ".join(missed[a:b]) for a, b in zip(upto, upto[1:])]
            codes = np.insert(np.minimum(ids, ESCAPE).astype(np.uint16), ends, ESCAPE)
            at = np.flatnonzero((ids >= ESCAPE) & ~beyond)
            of = np.searchsorted(ends, at, "right")
            exact = np.stack([at - (ends - sizes)[of], ids[at]], axis=1).astype(np.int32)
            row = number + np.arange(len(texts))
            number += len(texts)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(row), part.column(0), part.column(1), _blobs(codes, sizes + 1),
                    _blobs(exact.ravel(), 2 * np.bincount(of, minlength=len(texts))), pa.array(others, pa.binary()),
                ],
                names=["row", "doc_id", "held_out", "ids", "exact", "others"],
            )

    return rows.mapInArrow(run, schema)


def _id_slices(batches: Iterator[pa.RecordBatch], column: int, symbols: int, tokens: int = 400_000) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Pieces of batches of about so many tokens: (rows, flat ids, sizes); the column after the ids' is ``exact``."""
    for batch in batches:
        sizes = pa.compute.binary_length(batch.column(column)).to_numpy(zero_copy_only=False).astype(np.int64) // 2
        start, total = 0, 0
        for i, n in enumerate(sizes):
            total += int(n)
            if total >= tokens or i == len(sizes) - 1:
                part = batch.slice(start, i + 1 - start)
                ids = _unblobbed(part.column(column), np.uint16)[0].astype(np.int64)
                ids[ids == ESCAPE] = symbols - 1
                ends = np.cumsum(sizes[start : i + 1])
                exact, listed = _unblobbed(part.column(column + 1), np.int32)
                if len(exact):
                    exact = exact.reshape(-1, 2)
                    ids[np.repeat(ends - sizes[start : i + 1], listed // 2) + exact[:, 0]] = exact[:, 1]
                ids[ends - 1] = symbols - 2
                yield part, ids, sizes[start : i + 1]
                start, total = i + 1, 0


def start_model(train: DataFrame, symbols: int, base: np.ndarray, states: int, words: int) -> Model:
    """Classes of the most frequent words from which words stand next to which, over
    all training documents; at most words^2 counts reach the driver."""
    words = min(words, symbols - 2)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = np.zeros(words * words, dtype=np.int64)
        for _, ids, _ in _id_slices(batches, 0, symbols):
            # the next frequent word, skipping others, within documents (the end symbol parts them)
            kept = ids[(ids < words) | (ids == symbols - 2)]
            a, b = kept[:-1], kept[1:]
            ok = (a < words) & (b < words)
            pairs += np.bincount(a[ok] * words + b[ok], minlength=words * words)
        at = np.flatnonzero(pairs)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(pairs[at])], names=["pair", "n"])

    counts = np.zeros((words, words))
    if words:
        found = train.select("ids", "exact").mapInArrow(run, "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n")).toPandas()
        counts.ravel()[found["pair"].to_numpy()] = found["n"].to_numpy()
    classes = _classes(counts, states)
    member = np.zeros((words, states))
    member[np.arange(words), classes] = 1.0
    emits = np.repeat(base[:, None], states, axis=1)
    emits[:words] *= 0.1 + member * (states - 0.1 * (states - 1) - 0.1)
    emits /= emits.sum(axis=0)
    moves = member.T @ counts @ member + 1.0
    moves /= moves.sum(axis=1)[:, None]
    return Model(np.full(states, 1.0 / states), 0.5 * moves + 0.5 * np.eye(states), emits)


def _classes(counts: np.ndarray, k: int) -> np.ndarray:
    n = len(counts)
    if n <= k:
        return np.arange(n)
    both = counts + counts.T
    total = both.sum()
    if not total:
        return np.arange(n) % k
    share = both.sum(axis=1) / total
    lift = np.log((both / total + 1e-12) / (np.outer(share, share) + 1e-12))
    u, s, _ = np.linalg.svd(np.maximum(lift, 0))
    points = u[:, :k] * s[:k]
    norm = np.linalg.norm(points, axis=1)
    points = points / np.where(norm > 0, norm, 1)[:, None]
    centres = [points[int(np.argmax(share))]]
    while len(centres) < k:  # the farthest point next, weighted by frequency
        d = np.min([((points - c) ** 2).sum(axis=1) for c in centres], axis=0)
        centres.append(points[int(np.argmax(d * np.sqrt(share)))])
    centre = np.array(centres)
    for _ in range(20):
        label = np.argmin(((points[:, None] - centre[None]) ** 2).sum(axis=2), axis=1)
        for j in range(k):
            if (label == j).any():
                centre[j] = np.average(points[label == j], axis=0, weights=share[label == j] + 1e-12)
    return label


@dataclass
class Rest:
    """The words beyond the bounded table: rows (word, n, t0, t1, ...) with their training
    count and the tokens expected in each state; a state's share of all tokens, and its scale."""

    table: DataFrame
    share: np.ndarray
    scale: np.ndarray

    def emissions(self, prior: float) -> Column:
        """Emissions in all states as parts of the base probability."""
        each = ((F.col(f"t{j}") + prior * float(p)) / ((F.col("n") + prior) * float(p * z)) for j, (p, z) in enumerate(zip(self.share, self.scale)))
        return F.array(*each)

    def packed(self, prior: float) -> list[Column]:
        """The same, rounded to 1/32768 of an octave, three states in a long each."""
        each = self.emissions(prior)
        codes = [F.greatest(F.lit(0), F.least(F.lit(MOST), F.round((F.log2(each[j]) + OCTAVES) * STEPS))).cast("long") for j in range(len(self.share))]
        return [_sum(F.shiftleft(c, 21 * i) for i, c in enumerate(codes[g : g + 3])) for g in range(0, len(codes), 3)]


def _sum(parts: Iterator[Column]) -> Column:
    return reduce(lambda a, b: a + b, parts)


def unpacked(packed: np.ndarray, states: int) -> np.ndarray:
    """Emissions (rows x states) from their longs (rows x a third as many)."""
    codes = (packed[:, :, None] >> np.array([0, 21, 42])) & MOST
    return np.exp2(codes.reshape(len(packed), -1)[:, :states] / STEPS - OCTAVES)


def other_words(numbered: DataFrame) -> DataFrame:
    """Rows (row, at, word): the words beyond the bounded table, one by one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 2_000):
                part = batch.slice(start, 2_000)
                words = [(x or b"").split() for x in part.column(1).to_pylist()]
                sizes = np.fromiter(map(len, words), np.int64, len(words))
                at = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                row = np.repeat(part.column(0).to_numpy(), sizes)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row), pa.array(at.astype(np.int32)), pa.array(list(chain.from_iterable(words)), pa.binary())], names=["row", "at", "word"])

    return numbered.select("row", "others").mapInArrow(run, "row long, at int, word binary")


def with_emissions(numbered: DataFrame, rest: Rest, z: float, prior: float, keep_words: bool = False) -> DataFrame:
    """Rows (doc_id, held_out, ids, exact, words, own, others, known): the emissions ``own`` of the
    words beyond the bounded table, in order, their base log10 probability and how many are known.

    Each such token is a row, joined by word with a merge join (it spills, and adaptive execution
    splits a hot word) and put together again by row."""
    codes = np.clip(np.rint((OCTAVES - np.log2(rest.scale)) * STEPS), 0, MOST).astype(np.int64)
    unknown = [sum(int(c) << 21 * i for i, c in enumerate(codes[g : g + 3])) for g in range(0, len(codes), 3)]
    packs = [f"own{g}" for g in range(len(unknown))]
    known = rest.table.select("word", "n", *(c.alias(p) for p, c in zip(packs, rest.packed(prior))))
    n = F.coalesce("n", F.lit(0))
    # flat: a list in each of so many values would be half of what is shuffled
    token = F.struct("at", *(F.coalesce(p, F.lit(u).cast("long")).alias(p) for p, u in zip(packs, unknown)))
    tokens = (
        other_words(numbered).join(known.hint("merge"), "word", "left")
        .groupBy("row").agg(
            F.sort_array(F.collect_list(token)).alias("tokens"),
            F.sum(F.log10((n + ADD) / F.lit(float(z)))).alias("base"), F.sum((n > 0).cast("long")).alias("known"),
        )
    )
    words = F.col("others") if keep_words else F.lit(None).cast("binary")
    return numbered.select("row", "doc_id", "held_out", "ids", "exact", words.alias("words")).join(tokens.hint("merge"), "row", "left").select(
        "doc_id", "held_out", "ids", "exact", "words", F.flatten(F.transform("tokens", lambda x: F.array(*(x[p] for p in packs)))).alias("own"),
        F.coalesce("base", F.lit(0.0)).alias("others"), F.coalesce("known", F.lit(0)).alias("known"),
    )


def _own(part: pa.RecordBatch, column: int, states: int) -> np.ndarray | None:
    values = part.column(column).flatten().to_numpy(zero_copy_only=False)
    return unpacked(values.reshape(-1, (states + 2) // 3), states) if len(values) else None


def baum_welch(train: DataFrame, model: Model, base: np.ndarray, z: float, prior: float = PRIOR, words: bool = False) -> tuple[Model, Rest | None, float]:
    """One round over all rows of ``train`` (ids, exact, words, own): the new model, with ``words`` the other words'
    table (without, they go on sharing their emissions), and the log likelihood (natural, less the words'
    base) under the old model. ``base``: the bounded table's base probabilities, the end token last."""
    k, symbols = len(model.start), len(model.emits)
    # emissions as parts of the base probability stay near one, so single precision will do
    parts = [f"t{j}" for j in range(k)]
    near = Model(model.start, model.moves, model.emits / np.append(base, 1.0)[:, None])
    shared = train.sparkSession.sparkContext.broadcast(Model(*(x.astype(np.float32) for x in vars(extended(near)).values())))
    packs = [f"p{g}" for g in range((k + 2) // 3)]
    schema = pa.schema([("word", pa.binary()), ("n", pa.int64()), *((c, pa.int64()) for c in packs), ("e", pa.list_(pa.float64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        moves, emits, log = np.zeros((k + 1, k + 1)), np.zeros((symbols, k + 1)), 0.0
        for part, ids, sizes in _id_slices(batches, 0, symbols, 200_000):
            s = Slice(ids, sizes, shared.value, _own(part, 3, k))
            a, b, c = s.expected()
            moves, emits, log = moves + a, emits + b, log + c
            found = b" ".join(filter(None, part.column(2).to_pylist())).split() if words else ()
            if len(found):
                coded = pa.compute.dictionary_encode(pa.array(found, pa.binary()))
                at, weights = coded.indices.to_numpy(), s.weights[1:, ids == symbols - 1]
                n = np.bincount(at)
                mean = [np.rint(np.minimum(np.bincount(at, w) / n, 1.0) * WHOLE).astype(np.int64) for w in weights]
                packed = [pa.array(sum(m << 20 * i for i, m in enumerate(mean[g : g + 3]))) for g in range(0, k, 3)]
                yield pa.RecordBatch.from_arrays([coded.dictionary.cast(pa.binary()), pa.array(n), *packed, pa.nulls(len(n), schema.field("e").type)], schema=schema)
        # the bounded table under keys that no word can have (a space and a number): symbols first,
        # then one row per state's moves, then the likelihood
        rows = np.concatenate([emits, moves, np.full((1, k + 1), log)])[:, 1:]
        at = np.flatnonzero(rows.any(axis=1))
        keys = pa.array([b" %d" % x for x in at], pa.binary())
        values = pa.ListArray.from_arrays(np.arange(len(at) + 1, dtype=np.int32) * k, rows[at].ravel())
        none = pa.array(np.zeros(len(at), dtype=np.int64))
        yield pa.RecordBatch.from_arrays([keys, none, *(none for _ in packs), values], schema=schema)

    counted = train.select("ids", "exact", "words" if words else F.lit(None), "own").mapInArrow(run, "word binary, n long, " + ", ".join(f"{c} long" for c in packs) + ", e array<double>")
    # the rows are sums of slices already: they travel packed, and sums of whole numbers are the same in any order
    sums = (
        (F.coalesce(F.sum(F.col("e")[j]), F.lit(0.0)) + F.sum(F.col("n") * F.shiftright(packs[j // 3], 20 * (j % 3)).bitwiseAND(WHOLE)) / WHOLE).cast("float").alias(c)
        for j, c in enumerate(parts)
    )
    counted = counted.repartition("word").groupBy("word").agg(F.sum("n").alias("n"), *sums)
    key = F.substring("word", 1, 1) == F.lit(b" ")
    if words:  # the driver's part and the words' table come from one pass over the texts
        counted = written(counted)
    found = counted.where(key).select("word", *parts).toPandas()
    rows = np.zeros((symbols + k + 2, k))
    rows[[int(x) for x in found["word"]]] = found[parts].to_numpy()
    emits, moves, log = rows[:symbols], rows[symbols:-1], float(rows[-1, 0])
    start = (moves[0] + 1.0) / (moves[0] + 1.0).sum()
    moves = (moves[1:] + 1.0) / (moves[1:] + 1.0).sum(axis=1)[:, None]
    share = np.maximum(emits.sum(axis=0) / max(emits.sum(), 1.0), 1e-12)
    # one row for each symbol, the last for the other words together
    part = (emits + prior * share) / ((emits.sum(axis=1)[:, None] + prior) * share)
    if not words:
        unseen = np.maximum(1 - base.sum(), 0.0)
        scale = (base[:, None] * part[:-1]).sum(axis=0) + unseen * part[-1]
        return Model(start, moves, np.concatenate([base[:, None] * part[:-1], part[-1:]]) / scale), None, log
    rest = Rest(counted.where(~key), share, np.ones(k))
    each = rest.emissions(prior)
    mass = rest.table.agg(*(F.coalesce(F.sum((F.col("n") + ADD) / F.lit(float(z)) * each[j]), F.lit(0.0)) for j in range(k))).first()
    rest.scale = (base[:, None] * part[:-1]).sum(axis=0) + np.array(mass) + ADD / z
    return Model(start, moves, np.concatenate([base[:, None] * part[:-1], np.ones((1, k))]) / rest.scale), rest, log


def score(
    docs: DataFrame,
    held_out: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    own_words: int = OWN_WORDS,
    states: int = STATES,
    rounds: int = ROUNDS,
    start_words: int = START_WORDS,
    prior: float = PRIOR,
    tolerance: float = TOLERANCE,
    part_each_round: bool = True,
) -> DataFrame:
    """Train on the rows where ``held_out`` is false and score all rows: (doc_id,
    held_out, n_tokens, n_known, train_tokens, base_score, score), one per row."""
    spark = docs.sparkSession
    ship_package(spark)
    rows = docs.select(named(id_col).alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held_out"), named(text_col).alias("text"))
    counts = written(count_words(rows.where(~F.col("held_out")).select("text")))
    total, types = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    top = most_frequent(counts, "word", "c", own_words).toPandas()
    vocabulary = {bytes(w): i for i, w in enumerate(top["word"])}
    numbered = written(_numbered(rows, vocabulary))
    train = numbered.where(~F.col("held_out"))
    ends = train.count()
    n, v = total + ends, types + (ends > 0)
    z = n + ADD * (v + 1)
    own = top["c"].to_numpy().astype(np.float64) + ADD
    # the end token, if no document was there to train on, is the unknown word
    base = np.append(own, ends + ADD) / z
    beyond = (total - own.sum() + ADD * len(own)) + ADD * (types - len(own)) + ADD
    all_base = np.append(base, beyond / z)
    model = start_model(train, len(all_base), all_base / all_base.sum(), states, start_words)
    # the last symbol's emissions are parts of its words' base probabilities
    model.emits[-1] /= all_base[-1]
    k = len(model.start)
    # counts with equal parts in all states; before the first round no word beyond the table differs from the others
    rest = Rest(counts.select("word", F.col("c").alias("n"), *((F.col("c") / k).alias(f"t{j}") for j in range(k))), np.full(k, 1 / k), 1 / model.emits[-1])
    shared = train.select("ids", "exact", F.col("others").alias("words"), F.array().cast("array<long>").alias("own"))
    before, most = -np.inf, rounds if ends else 0
    for nth in range(most if part_each_round else most - 1):
        seen = with_emissions(train, rest, z, prior, True) if nth and part_each_round else shared
        model, found, log = baum_welch(seen, model, base, z, prior, part_each_round)
        rest = found or rest
        if nth > part_each_round and log - before < tolerance * n:
            break
        before = log
    if most and not part_each_round:
        model, rest, _ = baum_welch(shared, model, base, z, prior, True)
    shared = spark.sparkContext.broadcast((model, np.append(np.log10(base), 0.0)))
    schema = StructType([numbered.schema["doc_id"], numbered.schema["held_out"], *_parse_datatype_string("n_tokens long, n_known long, base_score double, score double").fields])
    end_known = 0 if ends else -1  # tokens of the bounded table count the end token

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, table = shared.value
        for part, ids, sizes in _id_slices(batches, 2, len(table), 200_000):
            others = part.column(5).to_numpy(zero_copy_only=False)
            log = log_likelihoods(ids, sizes, model, _own(part, 4, len(model.start))) / np.log(10)
            first = np.cumsum(sizes) - sizes
            bounded = np.add.reduceat((ids < len(table) - 1).astype(np.int64), first)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(sizes), pa.array(bounded + end_known + part.column(6).to_numpy(zero_copy_only=False)),
                 pa.array(np.add.reduceat(table[ids], first) + others), pa.array(log + others)],
                names=["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"],
            )

    rows = with_emissions(numbered, rest, z, prior).select("doc_id", "held_out", "ids", "exact", "own", "others", "known")
    return rows.mapInArrow(run, schema).select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(int(n)).cast("long").alias("train_tokens"), "base_score", "score")
