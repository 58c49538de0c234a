"""Word-level BPE encoding with a minimal acyclic transducer as the lexicon.

The frequent words of the corpus are compiled, with their token ids as outputs,
into a minimal acyclic automaton (equal suffixes share states). Every arc carries
the number of lexicon words that sort before it, so the sum along a word's path
is the word's number, which points at its ids. The automaton is a handful of flat arrays in
one memory-mapped file per Python worker; all distinct words of a slice walk it
together, one vector step per byte. Words it does not hold are merged exactly:
again all together, each round applies to every word its lowest-ranked pair,
leftmost first.

The vocabulary file is one of the "tokenizers" library's word-level BPE files with NFC,
white-space and lower-case normalisation, a word pattern, bytes as characters,
an end-of-word suffix and no decoder. It is read on the driver; ``path`` is a
parameter.

Defined results: a null text counts as empty (no tokens, empty decoding);
repeated rows give repeated results; an empty table gives no rows (and an empty
lexicon is a valid one).
"""

from __future__ import annotations

import hashlib
import json
import mmap
import re
import tempfile
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, _parse_datatype_string

from .common import most_frequent, pick, slices, written

#: Most words of the lexicon: what bounds the file that every worker maps.
LEXICON_WORDS = 1 << 16

#: Distinct words a worker remembers.
CACHE = 400_000


Ranges = list[tuple[int, int]]


@lru_cache(maxsize=1)
def character_classes() -> tuple[Ranges, Ranges, Ranges, dict[int, str]]:
    """Ranges of letters, numbers and white space, and the lower case where it
    differs from Python's. All as the library's own regular expressions and normaliser
    have them: Unicode versions differ between libraries. Read once, on the driver."""
    from tokenizers import Regex, normalizers, pre_tokenizers

    def block(start: int) -> list[str]:
        return [chr(c) for c in range(start, start + 4096) if not 0xD800 <= c < 0xE000]

    def matched(pattern: str) -> Ranges:
        split = pre_tokenizers.Split(Regex(pattern), "removed", invert=True)
        found = set()
        for i in range(0, 0x110000, 4096):
            found.update(*(map(ord, x) for x, _ in split.pre_tokenize_str("!".join(block(i)))))
        ranges: Ranges = []
        for c in sorted(found):
            if ranges and ranges[-1][1] == c - 1:
                ranges[-1] = (ranges[-1][0], c)
            else:
                ranges.append((c, c))
        return ranges

    lower = normalizers.Lowercase()
    odd = {ord(c): low for i in range(0, 0x110000, 4096) for c in block(i) if (low := lower.normalize_str(c)) != c.lower()}
    odd[ord("Σ")] = "σ"  # lower-casing goes character by character: no final sigma
    return matched(r"\p{L}+"), matched(r"\p{N}"), matched(r"\s"), odd


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, extra = [""] * 256, 0
    for b in range(256):
        if b in shown:
            out[b] = chr(b)
        else:
            out[b], extra = chr(256 + extra), extra + 1
    return out


class Vocabulary:
    """Token strings, byte symbols and merge ranks of a vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            data = json.load(f)
        model = data["model"]
        ids = model["vocab"]
        suffix = model["end_of_word_suffix"] or ""
        chars = byte_characters()
        self.specials = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.classes = character_classes()
        self.tokens = [""] * (max([*ids.values(), *self.specials.values()]) + 1)
        for token, i in chain(ids.items(), self.specials.items()):
            self.tokens[i] = token
        self.inner = np.array([ids[c] for c in chars], dtype=np.int64)
        self.last = np.array([ids[c + suffix] for c in chars], dtype=np.int64)
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        size = len(self.tokens)
        keys = np.array([ids[a] * size + ids[b] for a, b in merges], dtype=np.int64)
        made = np.array([ids[a + b] for a, b in merges], dtype=np.int64)
        by = np.argsort(keys, kind="stable")
        self.size, self.keys, self.ranks, self.made = size, keys[by], by.astype(np.int64), made[by]
        # a table by hashed pair, so that a lookup is one or two steps
        self.bits = max(4, int(len(keys) * 4).bit_length())
        self.slots = np.full(1 << self.bits, -1, dtype=np.int32)
        pending = np.arange(len(keys))
        at = self._slot(self.keys)
        while len(pending):
            free = pending[self.slots[at[pending]] < 0]
            self.slots[at[free]] = free  # of several for one slot the last one stays
            pending = pending[self.slots[at[pending]] != pending]
            at[pending] = (at[pending] + 1) & (len(self.slots) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def pairs(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Index of each pair's merge, -1 if there is none."""
        keys = left * self.size + right
        at = self._slot(keys)
        found = self.slots[at]
        wrong = np.flatnonzero((found >= 0) & (self.keys[found] != keys))
        while len(wrong):
            at[wrong] = (at[wrong] + 1) & (len(self.slots) - 1)
            found[wrong] = self.slots[at[wrong]]
            wrong = wrong[(found[wrong] >= 0) & (self.keys[found[wrong]] != keys[wrong])]
        return found

    def merge_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of many words (flat) and the number of ids of each: exact
        BPE, all words one merge further in each round."""
        sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        raw = np.frombuffer(b"".join(words), dtype=np.uint8)
        symbols = self.inner[raw]
        ends = np.cumsum(sizes)
        symbols[ends[sizes > 0] - 1] = self.last[raw[ends[sizes > 0] - 1]]
        word = np.repeat(np.arange(len(words)), sizes)
        final: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        order = np.arange(len(symbols))
        pair = np.full(len(symbols), -1, dtype=np.int64)
        if len(symbols) > 1:
            inside = np.flatnonzero(word[:-1] == word[1:])
            pair[inside] = self.pairs(symbols[inside], symbols[inside + 1])
        none = np.iinfo(np.int64).max
        while len(symbols):
            rank = np.where(pair >= 0, self.ranks[pair], none)
            starts = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            best = np.minimum.reduceat(rank, starts)
            lengths = np.diff(np.append(starts, len(word)))
            done = np.repeat(best == none, lengths)
            if done.any():
                final.append((word[done], order[done], symbols[done]))
                live = ~done
                word, order, symbols, pair, rank = word[live], order[live], symbols[live], pair[live], rank[live]
                best, lengths = best[best != none], lengths[best != none]
                if not len(word):
                    break
                starts = np.cumsum(lengths) - lengths
            hit = rank == np.repeat(best, lengths)
            # the leftmost place of each word's best pair
            where = np.flatnonzero(hit)
            where = where[np.append(True, word[where][1:] != word[where][:-1])]
            symbols[where] = self.made[pair[where]]
            keep = np.ones(len(word), dtype=bool)
            keep[where + 1] = False
            moved = np.cumsum(keep) - 1
            word, order, symbols, pair = word[keep], order[keep], symbols[keep], pair[keep]
            now = moved[where]
            for left in (now, now[now > 0] - 1):  # only pairs beside a merge changed
                has_next = (left + 1 < len(word)) & (word[np.minimum(left + 1, len(word) - 1)] == word[left])
                pair[left] = -1
                left = left[has_next]
                pair[left] = self.pairs(symbols[left], symbols[left + 1])
        if not final:
            return np.zeros(0, dtype=np.int64), np.zeros(len(words), dtype=np.int64)
        word, order, symbols = (np.concatenate(x) for x in zip(*final))
        by = np.argsort(order, kind="stable")
        return symbols[by], np.bincount(word, minlength=len(words))


# ---------------------------------------------------------------- the lexicon


def compile_lexicon(words: Iterable[bytes], vocabulary: Vocabulary) -> bytes:
    """The transducer of the given words as one block of bytes.

    Incremental construction over the sorted words: the states of the last word
    stay open; a state that no later word can extend is replaced by an equal one
    from the register, if there is one, so equal suffixes are stored once."""
    words = sorted(set(words) - {b""})
    ids, lengths = vocabulary.merge_words(words) if words else (np.zeros(0, np.int64), np.zeros(0, np.int64))
    register: dict[tuple, int] = {}
    states: list[tuple[bool, tuple]] = []  # (is a word's end, ((byte, state), ...))

    def freeze(node: list) -> int:
        key = (node[0], tuple(node[1]))
        number = register.get(key)
        if number is None:
            number = register[key] = len(states)
            states.append(key)
        return number

    path: list[list] = [[False, []]]  # open states along the last word
    previous = b""
    for word in words:
        common = 0
        limit = min(len(word), len(previous))
        while common < limit and word[common] == previous[common]:
            common += 1
        while len(path) > common + 1:
            node = path.pop()
            path[-1][1].append((previous[len(path) - 1], freeze(node)))
        for _ in word[common:]:
            path.append([False, []])
        path[-1][0] = True
        previous = word
    while len(path) > 1:
        node = path.pop()
        path[-1][1].append((previous[len(path) - 1], freeze(node)))
    root = freeze(path[0])

    # words below each state; states are numbered children first
    below = np.zeros(len(states), dtype=np.int64)
    keys, targets, skipped = [], [], []
    for s, (end, arcs) in enumerate(states):
        passed = int(end)
        for byte, target in arcs:
            keys.append(s * 256 + byte)
            targets.append(target)
            skipped.append(passed)
            passed += int(below[target])
        below[s] = passed
    arrays = [
        np.array([root, len(words)], dtype=np.int64),
        np.array(keys, dtype=np.int64),
        np.array(targets, dtype=np.int32),
        np.array(skipped, dtype=np.int32),
        np.array([end for end, _ in states], dtype=np.uint8),
        np.append(0, np.cumsum(lengths)).astype(np.int64),
        ids.astype(np.int32),
    ]
    head = json.dumps([[a.dtype.str, len(a)] for a in arrays]).encode()
    parts = [len(head).to_bytes(8, "little"), head, b"\0" * (-len(head) % 8)]
    for a in arrays:
        parts += [a.tobytes(), b"\0" * (-a.nbytes % 8)]
    return b"".join(parts)


class Lexicon:
    """A compiled lexicon in a memory-mapped file without a name: its pages are the
    system's to drop, and nothing is left behind when the worker ends."""

    def __init__(self, block: bytes):
        with tempfile.TemporaryFile() as f:
            f.write(block)
            f.flush()
            self.map = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        size = int.from_bytes(self.map[:8], "little")
        at, arrays = 8 + size + (-size % 8), []
        for kind, n in json.loads(self.map[8 : 8 + size]):
            a = np.frombuffer(self.map, dtype=kind, count=n, offset=at)
            at += a.nbytes + (-a.nbytes % 8)
            arrays.append(a)
        head, self.keys, self.targets, self.skipped, self.end, self.offsets, self.ids = arrays
        self.root, self.words = int(head[0]), int(head[1])
        # where each state's arcs begin, to search a few arcs only
        self.first = np.searchsorted(self.keys, np.arange(len(self.end) + 1) * 256)

    def find(self, words: list[bytes]) -> np.ndarray:
        """Each word's number, -1 if the lexicon does not hold it."""
        n = len(words)
        out = np.full(n, -1, dtype=np.int64)
        sizes = np.fromiter(map(len, words), dtype=np.int64, count=n)
        raw = np.frombuffer(b"".join(words), dtype=np.uint8)
        starts = np.cumsum(sizes) - sizes
        live = np.flatnonzero(sizes > 0)
        state, number, depth = np.full(len(live), self.root), np.zeros(len(live), dtype=np.int64), 0
        while len(live) and len(self.keys):
            key = state * 256 + raw[starts[live] + depth]
            lo, hi = self.first[state], self.first[state + 1]
            while True:  # binary search among the state's arcs, all words together
                open_ = lo < hi
                if not open_.any():
                    break
                mid = (lo + hi) >> 1
                less = open_ & (self.keys[np.minimum(mid, len(self.keys) - 1)] < key)
                lo, hi = np.where(less, mid + 1, lo), np.where(open_ & ~less, mid, hi)
            lo = np.minimum(lo, len(self.keys) - 1)
            ok = self.keys[lo] == key
            live, lo = live[ok], lo[ok]
            state, number = self.targets[lo].astype(np.int64), number[ok] + self.skipped[lo]
            depth += 1
            ended = sizes[live] == depth
            final = ended & (self.end[state] > 0)
            out[live[final]] = number[final]
            live, state, number = live[~ended], state[~ended], number[~ended]
        return out

    def outputs(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids and counts of the words with these numbers."""
        lengths = self.offsets[numbers + 1] - self.offsets[numbers]
        starts = np.cumsum(lengths) - lengths
        at = np.repeat(self.offsets[numbers] - starts, lengths) + np.arange(int(lengths.sum()))
        return self.ids[at].astype(np.int64), lengths


# ------------------------------------------------------------------- a worker


class Splitter:
    """Normalises texts and cuts them into words and special tokens."""

    def __init__(self, specials: dict[str, int], classes: tuple[Ranges, Ranges, Ranges, dict[int, str]]):
        *ranges, self.odd = classes
        self.specials = specials
        self.special = re.compile("(" + "|".join(map(re.escape, specials)) + ")") if specials else None

        def pattern(below: int) -> re.Pattern:
            # a class without characters of the higher planes is one table look-up
            letters, numbers, blanks = ("".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in r if b < below) for r in ranges)
            return re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{numbers}]|[^{blanks}{letters}{numbers}]+")

        self.find, self.find_all = pattern(0x10000).findall, pattern(0x110000).findall
        self.high = re.compile("[\U00010000-\U0010ffff]").search
        self.beyond_latin = re.compile("[^\x00-\u02ff]").search
        self.has_odd = re.compile("[" + "".join(map(re.escape, map(chr, self.odd))) + "]").search

    def words(self, text: str) -> list[str]:
        """The words and special tokens of a text, in order."""
        if self.special and any(s in text for s in self.specials):
            return list(chain.from_iterable([x] if x in self.specials else self._plain(x) for x in self.special.split(text)))
        return self._plain(text)

    def _plain(self, text: str) -> list[str]:
        if text.isascii() or not self.beyond_latin(text):
            return self.find(text.lower())  # composed already
        text = _nfc().normalize_str(text)
        if self.has_odd(text):
            text = text.translate(self.odd)
        return (self.find_all if self.high(text) else self.find)(text.lower())


@lru_cache(maxsize=1)
def _nfc():
    from tokenizers import normalizers

    return normalizers.NFC()


class Encoder:
    """Encodes slices of texts. Remembered words point into one flat array of ids;
    when there are too many, they are forgotten together."""

    def __init__(self, vocabulary: Vocabulary, lexicon: Lexicon):
        self.vocabulary, self.lexicon = vocabulary, lexicon
        self.splitter = Splitter(vocabulary.specials, vocabulary.classes)
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.starts, self.lengths = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        self.ids = np.zeros(0, dtype=np.int32)

    def _learn(self, new: list[str]) -> None:
        specials = self.vocabulary.specials
        words = [b"" if w in specials else w.encode() for w in new]
        numbers = self.lexicon.find(words)
        known, unknown = np.flatnonzero(numbers >= 0), np.flatnonzero(numbers < 0)
        ids_k, n_k = self.lexicon.outputs(numbers[known])
        ids_u, n_u = self.vocabulary.merge_words([words[i] for i in unknown])
        own = np.flatnonzero(np.fromiter((w in specials for w in new), dtype=bool, count=len(new)))
        lengths = np.zeros(len(new), dtype=np.int64)
        starts = lengths.copy()
        lengths[known], lengths[unknown], lengths[own] = n_k, n_u, 1
        starts[known], starts[unknown] = np.cumsum(n_k) - n_k, np.cumsum(n_u) - n_u + len(ids_k)
        starts[own] = len(ids_k) + len(ids_u) + np.arange(len(own))
        flat = np.concatenate([ids_k, ids_u, np.array([specials[new[i]] for i in own], dtype=np.int64)])
        self.number.update(zip(new, range(len(self.number), len(self.number) + len(new))))
        self.starts = np.concatenate([self.starts, starts + len(self.ids)])
        self.lengths = np.concatenate([self.lengths, lengths])
        self.ids = np.concatenate([self.ids, flat.astype(np.int32)])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The token ids of each text."""
        if len(self.number) > CACHE:
            self.forget()
        words = [self.splitter.words(t) for t in texts]
        new = list(set().union(*words).difference(self.number))
        if new:
            self._learn(new)
        sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        at = np.fromiter(map(self.number.__getitem__, chain.from_iterable(words)), dtype=np.int64, count=int(sizes.sum()))
        lengths = self.lengths[at]
        ids = _gather(self.ids, self.starts[at], lengths)
        total = np.append(0, np.cumsum(lengths))[np.append(0, np.cumsum(sizes))]
        return [ids[a:b] for a, b in zip(total[:-1], total[1:])]


def _gather(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    at = np.cumsum(lengths) - lengths
    return flat[np.repeat(starts - at, lengths) + np.arange(int(lengths.sum()))]


def decode(tokens: list[str], ids: np.ndarray) -> str:
    """Without a decoder in the vocabulary file, tokens are joined by spaces."""
    return " ".join([tokens[i] for i in ids.tolist()])


# ------------------------------------------------------------------ on Spark


def word_counts(docs: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """Rows (word binary, n) over all whole texts; tasks count before the shuffle."""
    rows = pick(docs, text=text_col)
    vocabulary = Vocabulary(path)
    shared = docs.sparkSession.sparkContext.broadcast((vocabulary.specials, vocabulary.classes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        specials, classes = shared.value
        splitter = Splitter(specials, classes)
        seen: Counter = Counter()

        def out() -> Iterator[pa.RecordBatch]:
            words = [w for w in seen if w not in specials]
            yield pa.RecordBatch.from_arrays(
                [pa.array([w.encode() for w in words], pa.binary()), pa.array([seen[w] for w in words], pa.int64())], names=["word", "n"]
            )
            seen.clear()

        for _, texts in slices(batches, 0):
            for t in texts:
                if t:
                    seen.update(splitter.words(t.decode("utf-8", "replace")))
            if len(seen) > CACHE:
                yield from out()
        yield from out()

    return rows.mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def build_lexicon(docs: DataFrame, path: str, text_col: str = "text", words: int = LEXICON_WORDS) -> bytes:
    """Compile the ``words`` most frequent words of the whole corpus (ties by
    bytes). At most that many words reach the driver."""
    vocabulary = Vocabulary(path)
    top = most_frequent(written(word_counts(docs, path, text_col)), "word", "n", words).select("word")
    return compile_lexicon((bytes(w) for w in top.toPandas()["word"]), vocabulary)


def encode_documents(
    docs: DataFrame, path: str, lexicon: bytes, id_col: str = "doc_id", text_col: str = "text", ids: bool = True
) -> DataFrame:
    """Rows (doc_id, n_tokens, ids_sha256, decoded_sha256[, ids]), one per row of
    ``docs``. The lexicon and the vocabulary are broadcast: both are bounded by
    parameters (LEXICON_WORDS, the vocabulary file), not by the data."""
    spark = docs.sparkSession
    rows = pick(docs, doc_id=id_col, text=text_col)
    shared = spark.sparkContext.broadcast((Vocabulary(path), lexicon))
    fields = _parse_datatype_string("n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * ids).fields
    schema = StructType([StructField("doc_id", rows.schema["doc_id"].dataType), *fields])
    names = [f.name for f in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, block = shared.value
        encoder, tokens = Encoder(vocabulary, Lexicon(block)), vocabulary.tokens
        for part, texts in slices(batches, 1, 1 << 20):
            found = encoder.encode([(t or b"").decode("utf-8", "replace") for t in texts])
            columns = [
                part.column(0),
                pa.array([len(x) for x in found], pa.int64()),
                pa.array([hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in found]),
                pa.array([hashlib.sha256(decode(tokens, x).encode()).hexdigest() for x in found]),
            ]
            if ids:
                sizes = np.append(0, np.cumsum([len(x) for x in found])).astype(np.int32)
                flat = np.concatenate(found) if found else np.zeros(0, np.int32)
                columns.append(pa.ListArray.from_arrays(pa.array(sizes), pa.array(flat.astype(np.int32))))
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return rows.mapInArrow(run, schema)


def decode_documents(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Rows (doc_id, text): the token ids of each row as text again (null: empty)."""
    rows = pick(encoded, doc_id=id_col, ids=ids_col)
    shared = encoded.sparkSession.sparkContext.broadcast(Vocabulary(path).tokens)
    schema = StructType([StructField("doc_id", rows.schema["doc_id"].dataType), *_parse_datatype_string("text string").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = shared.value
        for batch in batches:
            texts = [" ".join([tokens[i] for i in x or []]) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return rows.mapInArrow(run, schema)
