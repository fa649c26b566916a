"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies, by an agenda of adjacent symbol pairs.

A text is prepared as its model says (a space mark in front, spaces turned
into marks) and starts as one symbol a character. The agenda holds every
pair of neighbours whose joined text is a piece, best score first, the
leftmost on a tie; the top pair is joined, its new neighbours enter the
agenda, and entries whose symbols have changed meanwhile are skipped. A
symbol that is no piece becomes its UTF-8 bytes where the vocabulary falls
back to bytes, else unknown (a run of them counts once). Pieces marked
unused are taken apart again along their merges.

Where no piece has a mark behind another character and none is user-defined,
no pair ever joins across the start of a word, nor between two characters that
no chain of pieces connects (a letter and a full stop, say). There texts are
cut into words, which are encoded apart, and the worker keeps what words
became, up to a bound. The agenda of a text or a long word is a heap. The short words of an Arrow batch that are not known yet go
through theirs side by side: their pairs' ranks stand in one array, and each
step joins the first least pair of every word.

``decode`` joins the pieces' texts, turns marks into spaces, drops the one
in front, and reads runs of byte pieces as UTF-8, each wrong byte as U+FFFD.

Every Arrow batch can be checked against the sentencepiece library
(``check``): the column ``agrees`` says whether the library's ids of the same
text, or its text of the same ids, are equal.

Edge cases. Null or empty text has no ids and decodes to an empty text; a null
list of ids as well. Repeated rows are encoded each. Texts are taken whole: a
word of a million characters takes n log n steps. An empty table gives no
rows. Other columns come back in ``row``, whatever their names. Models of
another type, or that normalize beyond marks, are refused when the worker
loads them.
"""

from __future__ import annotations

import re
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from riskspark.llm.common import chunks, ship_package

MARK = "▁"
CACHED_WORDS = 250_000
#: Characters of text, or ids, that a worker holds as Python objects at a time (one longer text is still taken whole).
CHUNK = 1 << 18
SHORT = 48
#: Stands before a user-defined symbol, so that it is never part of a joined piece; no text holds it.
FROZEN = "\ud800"
FIRST_BYTE = 0xDC00
_BYTES = re.compile("[\udc00-\udcff]+")
#: The rank of a pair that is no piece.
NONE = 1 << 60
#: Symbols of more than one character are numbered above the code points.
FIRST_JOINED, SYMBOLS = 0x110000, 1 << 21
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


class PieceModel:
    """Encoder and decoder of one model file."""

    def __init__(self, model_file: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as pb

        self.library = sentencepiece.SentencePieceProcessor(model_file=model_file)
        proto = pb.ModelProto.FromString(self.library.serialized_model_proto())
        spec, trained = proto.normalizer_spec, proto.trainer_spec
        if trained.model_type != 2 or trained.treat_whitespace_as_suffix:
            raise ValueError("a merge-type model with marks in front of words is needed")
        if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.escape_whitespaces:
            raise ValueError("a model that normalizes nothing but spaces to marks is needed")
        self.prefix = MARK if spec.add_dummy_prefix else ""
        self.kinds = [p.type for p in proto.pieces]
        self.unknown, self.fallback = self.kinds.index(UNKNOWN), trained.byte_fallback
        text = [(i, p) for i, p in enumerate(proto.pieces) if p.type in (NORMAL, USER_DEFINED, UNUSED)]
        rank = {score: k for k, score in enumerate(sorted({p.score for _, p in text}, reverse=True))}
        self.ranks = {p.piece: rank[p.score] for _, p in text}
        self.unused = {p.piece for p in proto.pieces if p.type == UNUSED}
        self.value = {i: int(p.piece[3:5], 16) for i, p in enumerate(proto.pieces) if p.type == BYTE}
        as_bytes = [np.array(i, "<i4").tobytes() for i in range(len(proto.pieces))]
        self.bytes_of_unknown, self.bytes_of_byte = as_bytes[self.unknown], {b: as_bytes[i] for i, b in self.value.items()}
        fixed = sorted((p.piece for p in proto.pieces if p.type == USER_DEFINED), key=len, reverse=True)
        self.bytes_of = {FROZEN * (p.type == USER_DEFINED) + p.piece: as_bytes[i] for i, p in text}
        self.fixed = set(fixed)
        self.start = re.compile("|".join([*map(re.escape, fixed), "."]), re.DOTALL) if fixed else None
        self.apart = not fixed and not self.unused and self.fallback and not any(MARK in p.lstrip(MARK) for p in self.ranks)
        if self.apart:
            self._make_pairs()
            self.cut = self._cut()
        surface = {UNKNOWN: trained.unk_surface, CONTROL: ""}
        # A byte piece stands as a lone surrogate, which no other piece holds, until its run is read.
        spelled = [chr(FIRST_BYTE + self.value[i]) if p.type == BYTE else surface.get(p.type, p.piece.replace(MARK, " "))
                   for i, p in enumerate(proto.pieces)]
        self.surfaces, self.is_byte = np.array(spelled, object), np.array([k == BYTE for k in self.kinds])
        self.spelled = pa.array([bytes([self.value[i]]) if i in self.value else x.encode("utf-8") for i, x in enumerate(spelled)], pa.large_binary())
        self.spaced = [bool(self.prefix) and k not in (BYTE, UNKNOWN) and x.startswith(" ") for k, x in zip(self.kinds, spelled)]
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _make_pairs(self):
        """All pairs of symbols that join to a piece, by ``left * SYMBOLS + right``."""
        self.joined = [p for p in self.ranks if len(p) > 1]
        self.id_of = np.full(FIRST_JOINED + len(self.joined), -1, "<i4")        # -1: no piece, bytes stand for it
        for k, p in enumerate(self.joined, FIRST_JOINED):
            self.id_of[k] = int.from_bytes(self.bytes_of[p], "little")
        for p in self.ranks:
            if len(p) == 1:
                self.id_of[ord(p)] = int.from_bytes(self.bytes_of[p], "little")
        number = {p: FIRST_JOINED + k for k, p in enumerate(self.joined)}
        if FIRST_JOINED + len(number) > SYMBOLS:
            raise ValueError("too many pieces")
        rows: dict[int, list[tuple[int, int, int]]] = {}
        for p, k in number.items():
            for i in range(1, len(p)):
                a, b = (ord(x) if len(x) == 1 else number.get(x) for x in (p[:i], p[i:]))
                if a is not None and b is not None:
                    rows.setdefault(a, []).append((b, self.ranks[p], k))
        size = 1 << 12
        while size < 4 * sum(map(len, rows.values())) or not self._place(rows, size):
            size *= 2

    def _place(self, rows: dict[int, list[tuple[int, int, int]]], size: int) -> bool:
        """Put the pairs into tables of ``size``: (a, b) stands at ``offset[a] + b``, in a free place for every b of a.

        False if a row finds no offset in some thousand tries.
        """
        self.offset, self.mask = np.zeros(SYMBOLS, np.int64), size - 1
        self.pair_keys = np.full(size, -1, np.int64)
        self.pair_ranks, self.pair_joined = np.full(size, NONE, np.int64), np.zeros(size, np.int64)
        taken: set[int] = set()
        for a, row in sorted(rows.items(), key=lambda x: -len(x[1])):
            rights = [b for b, _, _ in row]
            for step in range(4096):
                offset = (a + step) * 0x9E3779B1 & self.mask
                places = {offset + b & self.mask for b in rights}
                if len(places) == len(rights) and taken.isdisjoint(places):
                    break
            else:
                return False
            taken |= places
            self.offset[a] = offset
            for b, rank, joined in row:
                at = offset + b & self.mask
                self.pair_keys[at], self.pair_ranks[at], self.pair_joined[at] = a * SYMBOLS + b, rank, joined
        return True

    def _cut(self) -> re.Pattern:
        """Words: marks and the characters behind them that pieces connect with each other, or one that none connects."""
        above: dict[str, str] = {}

        def top(c: str) -> str:
            while above.setdefault(c, c) != c:
                above[c] = c = above[above[c]]
            return c

        for p in self.joined:
            rest = p.lstrip(MARK)
            for a, b in zip(rest, rest[1:]):
                above[top(a)] = top(b)
        together: dict[str, list[str]] = {}
        for c in above:
            together.setdefault(top(c), []).append(c)
        runs = ["[" + re.escape("".join(c)) + "]+" for c in sorted(together.values(), key=len, reverse=True)]
        return re.compile(f"{MARK}*(?:{'|'.join([*runs, '.'])})", re.DOTALL)

    def _symbols(self, text: str) -> list[str]:
        """The symbols that are left when the agenda is empty; an entry is rank * n + left."""
        symbols = [FROZEN + s if s in self.fixed else s for s in self.start.findall(text)] if self.start else list(text)
        n, ranks, unused = len(symbols), self.ranks, self.unused
        made: dict[str, tuple[str, str]] = {}
        agenda = []
        for i in range(n - 1):
            piece = symbols[i] + symbols[i + 1]
            if (rank := ranks.get(piece)) is not None:
                agenda.append(rank * n + i)
                if piece in unused:
                    made[piece] = symbols[i], symbols[i + 1]
        heapify(agenda)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        while agenda:
            rank, left = divmod(heappop(agenda), n)
            right = after[left]
            if right == n or not symbols[left]:
                continue
            piece = symbols[left] + symbols[right]
            if ranks.get(piece) != rank:
                continue
            symbols[left], symbols[right] = piece, ""
            after[left] = over = after[right]
            if over < n:
                before[over] = left
                joined = piece + symbols[over]
                if (rank := ranks.get(joined)) is not None:
                    heappush(agenda, rank * n + left)
                    if joined in unused:
                        made[joined] = piece, symbols[over]
            first = before[left]
            if first >= 0:
                joined = symbols[first] + piece
                if (rank := ranks.get(joined)) is not None:
                    heappush(agenda, rank * n + first)
                    if joined in unused:
                        made[joined] = symbols[first], piece
        rest = [s for s in symbols if s]
        return self._without_unused(rest, made) if made else rest

    def _without_unused(self, symbols: list[str], made: dict[str, tuple[str, str]]) -> list[str]:
        out, rest = [], symbols[::-1]
        while rest:
            s = rest.pop()
            if s in self.unused and s in made:
                rest += made[s][::-1]
            else:
                out.append(s)
        return out

    def _ranked(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs, NONE for those that join to no piece."""
        at = self.offset[left] + right & self.mask
        return np.where(self.pair_keys[at] == left * SYMBOLS + right, self.pair_ranks[at], NONE)

    def _side_by_side(self, words: list[str]) -> list[bytes]:
        """The ids of many words. A symbol is a character's code point, or lies above them."""
        symbols = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.int64)
        word, size = np.arange(len(words)), np.fromiter(map(len, words), np.int64, len(words))
        ranks = np.full(len(symbols), NONE, np.int64)
        ranks[:-1] = self._ranked(symbols[:-1], symbols[1:])
        ranks[np.cumsum(size) - 1] = NONE
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(word):
            least = np.minimum.reduceat(ranks, np.cumsum(size) - size)
            over = least == NONE
            if over.any():
                gone = np.repeat(over, size)
                done.append((np.repeat(word[over], size[over]), symbols[gone]))
                symbols, ranks = symbols[~gone], ranks[~gone]
                word, size, least = word[~over], size[~over], least[~over]
                if not len(word):
                    break
            owner = np.repeat(np.arange(len(word)), size)
            at = np.flatnonzero(ranks == least[owner])
            at = at[np.flatnonzero(np.diff(owner[at], prepend=-1))]            # the first of every word
            symbols[at] = self.pair_joined[self.offset[symbols[at]] + symbols[at + 1] & self.mask]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            symbols, ranks = symbols[keep], ranks[keep]
            at, size = at - np.arange(len(at)), size - 1
            end = np.cumsum(size) - 1
            right = self._ranked(symbols[at], symbols[np.minimum(at + 1, len(symbols) - 1)])
            ranks[at] = np.where(at == end, NONE, right)
            at = at[at > end - size + 1]
            ranks[at - 1] = self._ranked(symbols[at - 1], symbols[at])
        word, symbols = (np.concatenate(x) for x in zip(*done))
        order = np.argsort(word, kind="stable")
        word, ids = word[order], self.id_of[symbols[order]]
        data, ends = ids.tobytes(), (4 * np.searchsorted(word, np.arange(len(words) + 1))).tolist()
        out = [data[i:j] for i, j in zip(ends, ends[1:])]
        for k in np.unique(word[ids < 0]).tolist():         # words with characters that are no pieces
            out[k] = self._merged(words[k])
        return out

    def _as_bytes(self, symbol: str) -> bytes:
        return b"".join([self.bytes_of_byte[b] for b in symbol.encode("utf-8")])

    def _merged(self, text: str) -> bytes:
        out, again = [], False
        for s in self._symbols(text):
            found = self.bytes_of.get(s)
            if found is None:
                found = b"" if again else self.bytes_of_unknown
                if self.fallback:
                    found = self._as_bytes(s)
                again = True
            else:
                again = False
            out.append(found)
        return b"".join(out)

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of texts as little-endian 32-bit numbers."""
        prepared = [self.prefix + t.replace(" ", MARK) if t else "" for t in texts]
        if not self.apart:
            return [self._merged(t) for t in prepared]
        if len(self.words) > CACHED_WORDS:
            self.words, self.older = {}, self.words
        words, known, new = [self.cut.findall(t) for t in prepared], self.words, set()
        found, gaps = [], []                 # what is known of each text's words, and where nothing is
        for x in words:
            ids = list(map(known.get, x))
            at = [i for i, y in enumerate(ids) if y is None] if None in ids else []
            new.update([x[i] for i in at])
            found.append(ids)
            gaps.append(at)
        fresh = new.difference(self.older)
        back = list(new - fresh)
        known.update(zip(back, map(self.older.__getitem__, back)))
        short = [w for w in fresh if len(w) <= SHORT]
        if short:
            known.update(zip(short, self._side_by_side(short)))
        long = {w: self._merged(w) for w in fresh if len(w) > SHORT}       # not kept: they may be of any length
        for x, ids, at in zip(words, found, gaps):
            for i in at:
                ids[i] = known[x[i]] if len(x[i]) <= SHORT else long[x[i]]
        return [b"".join(ids) for ids in found]

    def decode(self, ids) -> str:
        """The text of ids (a list or an array); the space in front of the first piece that gives one goes."""
        kinds, surfaces, first, at = self.kinds, self.surfaces, "", 0
        ids = np.asarray(ids, np.int64)
        if self.prefix:
            while at < len(ids) and kinds[ids[at]] == CONTROL:
                at += 1
            if at < len(ids) and kinds[ids[at]] not in (BYTE, UNKNOWN) and surfaces[ids[at]].startswith(" "):
                first, at = surfaces[ids[at]][1:], at + 1
        rest = ids[at:]
        text = first + "".join(surfaces[rest].tolist())
        return _BYTES.sub(lambda run: utf8(bytes(ord(b) - FIRST_BYTE for b in run[0])), text) if self.is_byte[rest].any() else text

    def decode_all(self, lists: list[bytes]) -> list[str]:
        """The texts of many lists of ids, as ``encode`` gives them: their pieces' bytes end to end. Lists that begin with
        a control piece, or whose bytes are no text, are decoded piece by piece."""
        ids, out = np.frombuffer(b"".join(lists), "<i4"), []
        for x, spelled in zip(lists, _joined(self.spelled, pa.array(ids), np.cumsum([0] + [len(x) >> 2 for x in lists]))):
            first = int.from_bytes(x[:4], "little")
            try:
                text = None if x and self.kinds[first] == CONTROL else spelled.decode("utf-8")
            except UnicodeDecodeError:
                text = None
            if text is None:
                text = self.decode(np.frombuffer(x, "<i4"))
            elif x and self.spaced[first]:
                text = text[1:]
            out.append(text)
        return out


def _joined(values: pa.LargeBinaryArray, which: pa.Array, ends: np.ndarray) -> list[bytes]:
    """The values at ``which`` end to end, cut at ``ends``."""
    if not len(which):
        return [b""] * (len(ends) - 1)
    taken = values.take(which)
    _, offsets, data = taken.buffers()
    at, data = np.frombuffer(offsets, np.int64)[ends].tolist(), memoryview(data) if data else b""
    return [bytes(data[i:j]) for i, j in zip(at, at[1:])]


def utf8(data: bytes) -> str:
    """``data`` as text; every byte that is not part of a character becomes U+FFFD."""
    try:
        return data.decode("utf-8")
    except UnicodeDecodeError as e:
        return data[:e.start].decode("utf-8") + "�" + utf8(data[e.start + 1:]) if len(data) < 256 else _utf8_long(data)


def _utf8_long(data: bytes) -> str:
    out, at = [], 0
    while at < len(data):
        try:
            out.append(data[at:].decode("utf-8"))
            break
        except UnicodeDecodeError as e:
            out += [data[at:at + e.start].decode("utf-8"), "�"]
            at += e.start + 1
    return "".join(out)


@lru_cache(maxsize=2)
def model(model_file: str) -> PieceModel:
    """One model per Python worker and file."""
    return PieceModel(model_file)


def _rows(docs: DataFrame, column: str, kind: str, to: str) -> DataFrame:
    carried = [F.col(f"`{c}`") for c in docs.columns if c != column] or [F.lit(None).cast("int").alias("none")]
    return docs.select(F.struct(*carried).alias("row"), F.col(f"`{column}`").cast(kind).alias(to))


def encode(docs: DataFrame, model_file: str, text: str = "text", check: bool = True, decoded: bool = False) -> DataFrame:
    """(row, ids, agrees): ``row`` holds the other columns; ``agrees`` is null without ``check``. With ``decoded``, also
    what the ids decode to, as ``decoded``, in the same pass. The path is as on the workers."""
    ship_package(docs.sparkSession)
    rows = _rows(docs, text, "string", "text")
    schema = rows.select("row").schema.add("ids", ArrayType(IntegerType())).add("agrees", "boolean")
    schema = schema.add("decoded", "string") if decoded else schema

    def run(batches):
        m = model(model_file)
        for batch in batches:
            for first, end in chunks(pc.fill_null(pc.binary_length(batch["text"]), 0).to_pylist(), CHUNK):
                part = batch.slice(first, end - first)
                texts = [t or "" for t in part["text"].to_pylist()]
                ids = m.encode(texts)
                back, agrees = None, [None] * len(ids)
                if decoded:
                    back = m.decode_all(ids)
                if check:
                    theirs = m.library.encode(texts, num_threads=1)         # a task has one core
                    agrees = [np.fromiter(x, "<i4", len(x)).tobytes() == y for x, y in zip(theirs, ids)]
                    if decoded:
                        agrees = [x and y == z for x, y, z in zip(agrees, m.library.decode(theirs, num_threads=1), back)]
                ends = np.concatenate([[0], np.cumsum([len(x) >> 2 for x in ids])]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(ids), "<i4")))
                out = {"row": part["row"], "ids": lists, "agrees": pa.array(agrees, pa.bool_())}
                yield pa.RecordBatch.from_pydict(out | ({"decoded": pa.array(back, pa.string())} if decoded else {}))

    return rows.mapInArrow(run, schema)


def decode(tokens: DataFrame, model_file: str, ids: str = "ids", check: bool = True) -> DataFrame:
    """(row, text, agrees): the texts of lists of ids; ``row`` holds the other columns."""
    ship_package(tokens.sparkSession)
    rows = _rows(tokens, ids, "array<int>", "ids")
    schema = rows.select("row").schema.add("text", "string").add("agrees", "boolean")

    def run(batches):
        m = model(model_file)
        for batch in batches:
            sizes = pc.fill_null(pc.list_value_length(batch["ids"]), 0).to_pylist()
            for first, end in chunks(sizes, CHUNK):
                part = batch.slice(first, end - first)
                lists = [x or [] for x in part["ids"].to_pylist()]
                texts = [m.decode(x) for x in lists]
                agrees = [x == y for x, y in zip(m.library.decode(lists, num_threads=1), texts)] if check else [None] * len(texts)
                yield pa.RecordBatch.from_arrays([part["row"], pa.array(texts, pa.string()), pa.array(agrees, pa.bool_())],
                                                 names=["row", "text", "agrees"])

    return rows.mapInArrow(run, schema)
