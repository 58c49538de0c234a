"""SentencePiece encoding and decoding for merge-type vocabularies.

A text becomes its symbols (a leading blank is added, blanks are written as U+2581); the
agenda holds the adjacent pairs whose union is a piece, ordered by score, then from the
left, and the first entry is merged until none is left. Characters that are no piece
become the byte pieces of their UTF-8.

No piece of a supported vocabulary goes on from another character into U+2581, so no
merge crosses such a place: texts are cut there into units, and equal units are merged
once. Each unit has its agenda. Short units of a batch advance together: a matrix holds
every unit's agenda by position, and a step takes the first entry of each (``_together``);
longer ones keep a heap (``_agenda``), n log n at any length.

In every Arrow batch the units merged for the first time are also encoded, and the ids
of the texts also decoded, by the sentencepiece library (``check``); a difference fails the task.

Defined results: a null text counts as empty, an empty text has no ids; bytes that are
no UTF-8 count as U+FFFD; texts of any length are encoded whole (memory: one batch of
about a MB of text, or one text); equal scores merge from the left; repeated rows are
encoded each; an empty table gives no rows; other columns do not matter. In decoding, a null
list counts as empty.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructField, StructType, _parse_datatype_string

from .common import pick, slices

SPACE = "▁"
#: Units that advance together have at most so many symbols.
WIDTHS = (4, 6, 8, 10, 12, 16, 24, 32)
#: Cells of one matrix of agendas.
CELLS = 1 << 18
#: Units that a task remembers before it starts anew.
CACHE = 250_000
NONE = np.iinfo(np.int32).max
CODE_POINTS = 0x110000


class Pieces:
    """The vocabulary: pieces, the agenda's order, and the table of pairs."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

        with open(path, "rb") as f:
            self.model = f.read()
        spec = sentencepiece_model_pb2.ModelProto.FromString(self.model)
        of = SentencePieceProcessor(model_proto=self.model)
        n = of.vocab_size()
        kinds = sentencepiece_model_pb2.ModelProto.SentencePiece
        plain = [i for i in range(n) if spec.pieces[i].type == kinds.NORMAL]
        byte_of = {i: int(of.id_to_piece(i)[3:5], 16) for i in range(n) if of.is_byte(i)}
        norm = spec.normalizer_spec
        if (
            spec.trainer_spec.model_type != spec.trainer_spec.BPE or len(byte_of) != 256 or norm.precompiled_charsmap
            or not norm.add_dummy_prefix or norm.remove_extra_whitespaces or not norm.escape_whitespaces or spec.trainer_spec.treat_whitespace_as_suffix
            or any(p.type in (kinds.USER_DEFINED, kinds.UNUSED) for p in spec.pieces)
            or any(re.search(f"[^{SPACE}]{SPACE}", spec.pieces[i].piece) for i in plain)
        ):
            raise ValueError("not a merge-type vocabulary with byte pieces, identity normaliser and leading blanks")
        self.size = n
        piece_id = {of.id_to_piece(i): i for i in plain}
        self.bytes = np.zeros(256, dtype=np.int32)
        for i, b in byte_of.items():
            self.bytes[b] = i
        # symbols: piece ids; characters that are parts of pieces only; all other characters
        letters = sorted({c for p in piece_id for c in p} - set(piece_id))
        self.beyond = n + len(letters)
        symbol = piece_id | {c: n + k for k, c in enumerate(letters)}
        self.letters = np.array([ord(c) for c in letters], dtype=np.int64)
        self.symbol = np.arange(CODE_POINTS, dtype=np.int32) + self.beyond
        for s, k in symbol.items():
            if len(s) == 1:
                self.symbol[ord(s)] = k
        # a pair's place in the agenda: equal scores share it, the left one goes first
        score = {i: of.get_score(i) for i in plain}
        place = {s: k for k, s in enumerate(sorted(set(score.values()), reverse=True))}
        keys, to = [], []
        for p, i in piece_id.items():
            for cut in range(1, len(p)):
                a, b = symbol.get(p[:cut]), symbol.get(p[cut:])
                if a is not None and b is not None:
                    keys.append((a << 32) | b)
                    to.append(i)
        order = np.argsort(np.array(keys, dtype=np.int64))
        self.keys = np.append(np.array(keys, dtype=np.int64)[order], np.iinfo(np.int64).max)
        self.to = np.append(np.array(to, dtype=np.int32)[order], -1)
        self.place = np.append(np.array([place[score[i]] for i in to], dtype=np.int32)[order], NONE)
        # decoding
        self.texts = [b"" if of.is_control(i) else bytes([byte_of[i]]) if i in byte_of else
                      spec.trainer_spec.unk_surface.encode() if of.is_unknown(i) else of.id_to_piece(i).replace(SPACE, " ").encode() for i in range(n)]
        self.is_byte = np.array([i in byte_of for i in range(n)])
        self.leads = np.array([i in score and of.id_to_piece(i).startswith(SPACE) for i in range(n)])
        self.numbers = [str(i) for i in range(n)]

    # -------------------------------------------------------------- merging

    def pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in the agenda, merged symbol) of adjacent symbols; NONE if no piece."""
        key = (left.astype(np.int64) << 32) | right
        at = np.searchsorted(self.keys, key)
        hit = self.keys[at] == key
        return np.where(hit, self.place[at], NONE), self.to[at]

    def _together(self, symbols: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Merge rows of symbols (filled up with -1): one agenda a row, and each step
        takes the first entry of every row that has one. Pairs (row, symbols left)."""
        rows, width = np.arange(len(symbols)), symbols.shape[1]
        place, to = self.pairs(symbols[:, :-1], symbols[:, 1:])
        columns = np.arange(width)
        done = []
        while len(rows):
            at = place.argmin(axis=1)  # of equal ones the leftmost
            live = place[np.arange(len(rows)), at] != NONE
            if not live.all():
                done.append((rows[~live], symbols[~live]))
                rows, symbols, place, to, at = rows[live], symbols[live], place[live], to[live], at[live]
                if not len(rows):
                    break
            n = np.arange(len(rows))
            merged = to[n, at]
            # the right symbol and the pair's own entry go
            keep = columns[None, : width - 1] + (columns[None, : width - 1] > at[:, None])
            symbols = np.take_along_axis(symbols, keep, axis=1)
            symbols[n, at] = merged
            keep = columns[None, : width - 2] + (columns[None, : width - 2] >= at[:, None])
            place, to = np.take_along_axis(place, keep, axis=1), np.take_along_axis(to, keep, axis=1)
            width -= 1
            if width == 1:
                done.append((rows, symbols))
                break
            # its neighbours' entries are new
            left, right = np.flatnonzero(at > 0), np.flatnonzero(at < width - 1)
            place[left, at[left] - 1], to[left, at[left] - 1] = self.pairs(symbols[left, at[left] - 1], merged[left])
            place[right, at[right]], to[right, at[right]] = self.pairs(merged[right], symbols[right, at[right] + 1])
        return done

    def _agenda(self, symbols: np.ndarray) -> np.ndarray:
        """Merge one long unit; entries whose symbols have changed since are passed over."""
        n = len(symbols)
        place, to = self.pairs(symbols[:-1], symbols[1:])
        now = symbols.tolist()
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(int(place[i]), int(i), now[i], now[i + 1], int(to[i])) for i in np.flatnonzero(place != NONE)]
        heapq.heapify(heap)

        def offer(i: int, j: int) -> None:
            key = (now[i] << 32) | now[j]
            at = int(np.searchsorted(self.keys, key))
            if self.keys[at] == key:
                heapq.heappush(heap, (int(self.place[at]), i, now[i], now[j], int(self.to[at])))

        while heap:
            _, i, a, b, merged = heapq.heappop(heap)
            j = after[i]
            if now[i] != a or j >= n or now[j] != b:
                continue
            now[i], now[j] = merged, -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
                offer(i, after[j])
            if before[i] >= 0:
                offer(before[i], i)
        return np.array([s for s in now if s >= 0], dtype=np.int64)

    def merge(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids of each unit)."""
        sizes = np.fromiter(map(len, units), dtype=np.int64, count=len(units))
        starts = np.cumsum(sizes) - sizes
        symbols = self.symbol[np.frombuffer("".join(units).encode("utf-32-le"), dtype="<u4")]
        unit, final = [], []
        low = 0
        for width in WIDTHS:
            of = np.flatnonzero((sizes > low) & (sizes <= width))
            low = width
            for first in range(0, len(of), CELLS // width):
                block = of[first : first + CELLS // width]
                at = np.arange(width)[None, :]
                inside = at < sizes[block, None]
                matrix = np.where(inside, symbols[np.where(inside, starts[block, None] + at, 0)], -1)
                for row, left in self._together(matrix):
                    held = left >= 0
                    unit.append(np.repeat(block[row], held.sum(axis=1)))
                    final.append(left[held])
        for i in np.flatnonzero(sizes > low):
            left = self._agenda(symbols[starts[i] : starts[i] + sizes[i]])
            unit.append(np.full(len(left), i))
            final.append(left)
        if not unit:
            return np.zeros(0, dtype=np.int32), np.zeros(len(units), dtype=np.int64)
        owner, out = np.concatenate(unit), np.concatenate(final).astype(np.int64)
        order = np.argsort(owner, kind="stable")
        owner, out = owner[order], out[order]
        # characters without a piece: their bytes
        odd = np.flatnonzero(out >= self.size)
        if len(odd):
            code = np.where(out[odd] >= self.beyond, out[odd] - self.beyond, self.letters[np.minimum(out[odd] - self.size, len(self.letters) - 1)] if len(self.letters) else 0)
            spelled = [chr(c).encode() for c in code.tolist()]
            width = np.ones(len(out), dtype=np.int64)
            width[odd] = [len(b) for b in spelled]
            place = np.cumsum(width) - width
            ids = np.repeat(out, width)
            lengths = width[odd]
            spots = np.repeat(place[odd], lengths) + np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            ids[spots] = self.bytes[np.frombuffer(b"".join(spelled), dtype=np.uint8)]
            owner, out = np.repeat(owner, width), ids
        return out.astype(np.int32), np.bincount(owner, minlength=len(units))

    # -------------------------------------------------------------- decoding

    def decode(self, ids: list[int]) -> str:
        """Pieces joined; the blank that encoding put first goes; runs of byte pieces
        become characters, each byte that belongs to none U+FFFD."""
        parts = [self.texts[i] for i in ids]
        lead = next((i for i in ids if self.texts[i]), None)
        strip = int(lead is not None and bool(self.leads[lead]))
        if b"" not in parts:  # a control piece ends a run of bytes
            try:
                return b"".join(parts).decode()[strip:]
            except UnicodeDecodeError:
                pass
        out, run = [], bytearray()
        for i, part in zip(ids, parts):
            if self.is_byte[i]:
                run += part
                continue
            out.append(_characters(bytes(run)))
            run.clear()
            out.append(part.decode())
        return ("".join(out) + _characters(bytes(run)))[strip:]


def _characters(run: bytes) -> str:
    """UTF-8 character by character; a byte that starts none gives U+FFFD."""
    out, i = [], 0
    while i < len(run):
        for n in (1, 2, 3, 4):
            try:
                out.append(run[i : i + n].decode())
                i += n
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            i += 1
    return "".join(out)


class Encoder:
    """Texts to ids; remembers the units it has merged (``CACHE`` of them)."""

    def __init__(self, pieces: Pieces, check: bool = True):
        self.pieces = pieces
        self.library = None
        if check:
            from sentencepiece import SentencePieceProcessor

            self.library = SentencePieceProcessor(model_proto=pieces.model)
        self.unit = re.compile(f"{SPACE}+[^{SPACE}]*")
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.starts, self.lengths = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.int32)

    def _compare(self, units: list[str], ids: np.ndarray, lengths: np.ndarray) -> None:
        """The library's ids of these units, each as a text of its own (the library puts
        the first blank; a unit of a single blank would be an empty text, which has no ids)."""
        texts = [u[1:].replace(SPACE, " ") for u in units]
        flat, at = ids.tolist(), np.append(0, np.cumsum(lengths)).tolist()
        mine = [flat[a:b] for a, b in zip(at[:-1], at[1:])]
        theirs = self.library.encode(texts, num_threads=1)
        for text, a, b in zip(texts, mine, theirs):
            if a != b and text:
                raise ValueError(f"ids differ from the library's for {text[:80]!r}: {a[:20]} and {b[:20]}")

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.number) > CACHE:
            self.forget()
        units = [self.unit.findall(SPACE + t.replace(" ", SPACE)) if t else [] for t in texts]
        new = list(set(chain.from_iterable(units)).difference(self.number))
        if new:
            ids, lengths = self.pieces.merge(new)
            if self.library:
                self._compare(new, ids, lengths)
            self.number.update(zip(new, range(len(self.number), len(self.number) + len(new))))
            self.starts = np.concatenate([self.starts, np.cumsum(lengths) - lengths + len(self.ids)])
            self.lengths = np.concatenate([self.lengths, lengths])
            self.ids = np.concatenate([self.ids, ids])
        sizes = np.fromiter(map(len, units), dtype=np.int64, count=len(units))
        at = np.fromiter(map(self.number.__getitem__, chain.from_iterable(units)), dtype=np.int64, count=int(sizes.sum()))
        lengths = self.lengths[at]
        ends = np.cumsum(lengths)
        spots = np.repeat(self.starts[at] - ends + lengths, lengths) + np.arange(int(lengths.sum()))
        flat = self.ids[spots]
        cuts = np.append(0, ends)[np.append(0, np.cumsum(sizes))]
        return [flat[a:b] for a, b in zip(cuts[:-1], cuts[1:])]


# ------------------------------------------------------------------ on Spark


def encode_documents(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", ids: bool = True, check: bool = True
) -> DataFrame:
    """Rows (doc_id, n_tokens, ids_sha256, decoded_sha256[, ids]), one per row of ``docs``.
    The vocabulary is broadcast; its size is that of the file."""
    rows = pick(docs, doc_id=id_col, text=text_col)
    shared = docs.sparkSession.sparkContext.broadcast(Pieces(path))
    fields = _parse_datatype_string(
        "n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * ids).fields
    schema = StructType([StructField("doc_id", rows.schema["doc_id"].dataType), *fields])
    names = [f.name for f in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = shared.value
        encoder = Encoder(pieces, check)
        for part, raw in slices(batches, 1, 1 << 20):
            texts = [(t or b"").decode("utf-8", "replace") for t in raw]
            found = encoder.encode(texts)
            lists = [x.tolist() for x in found]
            decoded = [pieces.decode(x) for x in lists]
            if check and encoder.library.decode(lists, num_threads=1) != decoded:
                raise ValueError("the library decodes the ids of a batch to other texts")
            numbers = pieces.numbers
            columns = [
                part.column(0),
                pa.array([len(x) for x in found], pa.int64()),
                pa.array([hashlib.sha256(",".join([numbers[i] for i in x]).encode()).hexdigest() for x in lists]),
                pa.array([hashlib.sha256(x.encode()).hexdigest() for x in decoded]),
            ]
            if ids:
                sizes = np.append(0, np.cumsum([len(x) for x in found])).astype(np.int32)
                flat = np.concatenate(found) if found else np.zeros(0, np.int32)
                columns.append(pa.ListArray.from_arrays(pa.array(sizes), pa.array(flat)))
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return rows.mapInArrow(run, schema)


def decode_documents(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Rows (doc_id, text): the ids of each row as text again."""
    rows = pick(encoded, doc_id=id_col, ids=ids_col)
    shared = encoded.sparkSession.sparkContext.broadcast(Pieces(path))
    schema = StructType([StructField("doc_id", rows.schema["doc_id"].dataType), *_parse_datatype_string("text string").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = shared.value
        for batch in batches:
            texts = [pieces.decode(x or []) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return rows.mapInArrow(run, schema)
