"""Byte-level BPE as a bounded-lookahead streaming transducer, and its decoder."""

from __future__ import annotations

import codecs
import hashlib
import heapq
import json
import re
from array import array
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Split rule of the byte-level vocabularies (a fixed value of the format; the
#: alternatives that begin with different characters stand in order of frequency).
_RULE = r" ?[{L}]+| ?[{N}]+|'s|'t|'re|'ve|'m|'ll|'d| ?[^{S}{L}{N}]+|[{S}]+(?![^{S}])|[{S}]+"
SPLIT = _RULE.format(L=r"\p{L}", N=r"\p{N}", S=r"\p{White_Space}")
#: The same rule for texts of Latin characters up to U+017F only, spelled out for the
#: quicker engine of the standard library, and the characters that need the full one.
_LATIN = re.compile(_RULE.format(L="A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u017f", N="0-9\u00b2\u00b3\u00b9\u00bc-\u00be", S=" \t-\r\x85\xa0"))
_BEYOND = re.compile("[\u0180-\U0010ffff]")
#: A split always ends between a visible character and a space.
_CUT = regex.compile(r"(?<=\P{White_Space}) (?=\P{White_Space})")
_PIECE = 1 << 18
#: Words that a worker remembers as new ones, and as old ones.
_REMEMBERED = 150_000
_ID_BITS = 24
_ID_MASK = (1 << _ID_BITS) - 1
_NO_RULE = 1 << 62


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in a vocabulary file: printable
    ones stand for themselves, the others follow from code point 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def sufficient_lookahead(merges: Iterable[tuple[bytes, bytes]]) -> int:
    """Bytes after which a token can no longer change, for merges by rank.

    Two texts with a common beginning can differ at its end only. When a rule
    (u, v) is applied, the part on which they agree loses at most its last
    token, and only if that is u; from then on, a rule that takes the token
    before must have a right side that begins with u, and a higher rank. So
    what is lost at most is the longest chain of rules of rising rank in which
    each right side begins with the left side before it, in bytes of the left sides.
    """
    best: dict[bytes, int] = {}
    longest = 0
    for left, right in reversed(list(merges)):
        lost = len(left) + best.get(left, 0)
        longest = max(longest, lost)
        for k in range(1, len(right) + 1):
            if best.get(right[:k], 0) < lost:
                best[right[:k]] = lost
    return longest


class ByteBPE:
    """Encoder and decoder of a vocabulary file of the ``tokenizers`` library
    (byte-level BPE without normaliser; special tokens are found in the text)."""

    def __init__(self, content: str):
        spec = json.loads(content)
        vocab, alphabet = spec["model"]["vocab"], byte_alphabet()
        raw = lambda token: bytes(alphabet[c] for c in token)
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        self.byte_ids = [0] * 256
        for char, byte in alphabet.items():
            self.byte_ids[byte] = vocab[char]
        #: rank and new token of each pair, in one number that orders by rank
        self.rules = {(vocab[a], vocab[b]): rank << _ID_BITS | vocab[a + b] for rank, (a, b) in reversed([*enumerate(merges)])}
        self.bytes_of = {i: raw(token) for token, i in vocab.items()}
        special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.bytes_of |= {i: t.encode() for t, i in special.items()}
        self.special = special
        self.find_special = regex.compile("(" + "|".join(regex.escape(t) for t in sorted(special, key=len, reverse=True)) + ")") if special else None
        self.lookahead = sufficient_lookahead((raw(a), raw(b)) for a, b in merges)
        self.split = regex.compile(SPLIT)
        self.words = _Words(self)
        n = max(self.bytes_of, default=-1) + 1
        self.sizes = np.array([len(self.bytes_of.get(i, b"")) for i in range(n)], np.int64)
        self.places = np.cumsum(self.sizes) - self.sizes
        self.all_bytes = np.frombuffer(b"".join(self.bytes_of.get(i, b"") for i in range(n)), np.uint8)
        width = len(str(n)) + 1
        self.digits = np.frombuffer(b"".join(f"{i},".rjust(width).encode() for i in range(n)), np.uint8).reshape(n, width)

    def merge(self, data: bytes) -> list[int]:
        """Tokens of a short run of bytes: the pair of the lowest rank first, the
        leftmost among equals. Words are short, so looking through all pairs is
        the quickest way; longer runs keep their pairs in a heap."""
        ids = [self.byte_ids[b] for b in data]
        if len(ids) <= 48:
            rule = self.rules.get
            pairs = [rule(p, _NO_RULE) for p in zip(ids, ids[1:])]
            while pairs and (best := min(pairs)) < _NO_RULE:
                i, new = pairs.index(best), best & _ID_MASK
                ids[i] = new
                del ids[i + 1], pairs[i]
                if i:
                    pairs[i - 1] = rule((ids[i - 1], new), _NO_RULE)
                if i < len(pairs):
                    pairs[i] = rule((new, ids[i + 1]), _NO_RULE)
            return ids
        rules, after, before = self.rules, [*range(1, len(ids)), -1], [*range(-1, len(ids) - 1)]
        heap = [(rules[p], i, p) for i, p in enumerate(zip(ids, ids[1:])) if p in rules]
        heapq.heapify(heap)
        while heap:
            rule, i, (a, b) = heapq.heappop(heap)
            j, new = after[i], rule & _ID_MASK
            if ids[i] != a or j < 0 or ids[j] != b:
                continue
            ids[i], ids[j], after[i] = new, -1, after[j]
            if after[i] >= 0:
                before[after[i]] = i
                if (p := (new, ids[after[i]])) in rules:
                    heapq.heappush(heap, (rules[p], i, p))
            if before[i] >= 0 and (p := (ids[before[i]], new)) in rules:
                heapq.heappush(heap, (rules[p], before[i], p))
        return [t for t in ids if t >= 0]

    def stream(self, parts: Iterable[bytes]) -> Iterator[int]:
        """Tokens of one word given in parts, through the transducer."""
        machine = Transducer(self)
        for part in parts:
            yield from machine.feed(part)
        yield from machine.end()

    def word(self, word: str) -> list[int]:
        """Tokens of one word. Every word, short or long, is fed to the transducer;
        a long one in parts, so that it never holds more than a few of them."""
        data, step = word.encode("utf-8", "replace"), 4 * self.lookahead
        machine, out = Transducer(self), []
        for i in range(0, len(data), step):
            out += machine.feed(data[i:i + step])
        return out + machine.end()

    def pieces(self, text: str) -> Iterator[np.ndarray]:
        """Token ids of a text, a bounded piece of it at a time."""
        if any(t in text for t in self.special):
            parts = self.find_special.split(text)
        else:
            parts = [text]
        for part in parts:
            if part in self.special:
                yield np.array([self.special[part]], np.int32)
                continue
            split = (self.split if _BEYOND.search(part) else _LATIN).findall
            for piece in _pieces(part):
                yield np.frombuffer(b"".join(map(self.words.__getitem__, split(piece))), np.int32)

    def encode(self, text: str) -> array:
        out = array("i")
        for ids in self.pieces(text):
            out.frombytes(ids.tobytes())
        return out

    def bytes_in(self, ids: np.ndarray) -> bytes:
        """The bytes of token ids, one after the other; unknown ids give nothing."""
        known = ids[(ids >= 0) & (ids < len(self.sizes))]
        size = self.sizes[known]
        end = np.cumsum(size)
        at = np.arange(end[-1] if len(end) else 0) + np.repeat(self.places[known] - (end - size), size)
        return self.all_bytes[at].tobytes()

    def decode(self, ids: Iterable[int]) -> str:
        """The text of token ids, through the incremental decoder."""
        machine, rest, out = Decoder(self), iter(ids), []
        while len(some := np.fromiter(islice(rest, _PIECE), np.int64)):
            out.append(machine.feed(some))
        out.append(machine.end())
        return "".join(out)

    def decimals(self, ids: np.ndarray) -> bytes:
        """Ids as decimal digits, a comma after each."""
        rows = self.digits[ids]
        return rows[rows != 32].tobytes()


class Transducer:
    """Bytes of one word in, tokens out. A token leaves once ``lookahead`` bytes
    follow it, because nothing that comes later can change it then, or with the
    end of the word. What is held never exceeds a few times that and one part."""

    def __init__(self, model: ByteBPE):
        self.model, self.held = model, b""

    def feed(self, part: bytes) -> list[int]:
        """Takes some bytes and gives the tokens that are stable by now."""
        self.held += part
        if len(self.held) <= 4 * self.model.lookahead:
            return []
        at, end, out = 0, len(self.held) - self.model.lookahead, []
        for token in self.model.merge(self.held):
            if at + len(self.model.bytes_of[token]) > end:
                break
            at += len(self.model.bytes_of[token])
            out.append(token)
        self.held = self.held[at:]
        return out

    def end(self) -> list[int]:
        """The word is over: what is held becomes tokens."""
        held, self.held = self.held, b""
        return self.model.merge(held)


class Decoder:
    """Token ids in, text out: bytes go through an incremental UTF-8 machine that
    holds an unfinished character only; invalid bytes become U+FFFD."""

    def __init__(self, model: ByteBPE):
        self.model, self.machine = model, codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: np.ndarray) -> str:
        return self.machine.decode(self.model.bytes_in(ids))

    def end(self) -> str:
        return self.machine.decode(b"", True)


class _Words(dict):
    """Token ids of words met before, packed. When they are too many they become
    the old ones, from which a word that is met again is taken back; the old
    ones before them are forgotten."""

    def __init__(self, model: ByteBPE):
        super().__init__()
        self.model, self.old = model, {}

    def __missing__(self, word: str) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            ids = array("i", self.model.word(word)).tobytes()
        if len(word) <= 64:
            if len(self) >= _REMEMBERED:
                self.old = dict(self)
                self.clear()
            self[word] = ids
        return ids


def _pieces(text: str) -> Iterator[str]:
    at = 0
    while len(text) - at > _PIECE and (cut := _CUT.search(text, at + _PIECE)):
        yield text[at:cut.start()]
        at = cut.start()
    yield text[at:]


_MODELS: dict[int, ByteBPE] = {}


def _model(shared) -> ByteBPE:
    """The model of a broadcast vocabulary, built once per worker."""
    key = hash(shared.value)
    if key not in _MODELS:
        _MODELS.clear()
        _MODELS[key] = ByteBPE(shared.value)
    return _MODELS[key]


def _share(df: DataFrame, path: str):
    """The vocabulary file (a few MB, whatever the input) as a broadcast: only
    the driver needs the path."""
    with open(path, encoding="utf-8") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", slice_rows: int = 256) -> DataFrame:
    """``(id_col, ids array<int>)`` per row, over whole texts, as the ``tokenizers``
    library encodes without adding special tokens (their strings in a text are
    found). Null: as the empty text, no ids."""
    shared = _share(docs, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(shared)
        for b in batches:
            for at in range(0, b.num_rows, slice_rows):
                part = b.slice(at, slice_rows)
                ids, ends = array("i"), [0]
                for text in part.column(1):
                    ids.extend(model.encode(text.as_py() or ""))
                    ends.append(len(ids))
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(ids, np.int32) if ids else [], pa.int32()))
                yield pa.RecordBatch.from_arrays([part.column(0), lists], names=[id_col, "ids"])

    rows = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"`{id_col}` {rows.dtypes[0][1]}, ids array<int>")


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids", slice_rows: int = 256) -> DataFrame:
    """``(id_col, ids, text)`` per row of token ids. Null ids: the empty text."""
    shared = _share(encoded, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(shared)
        for b in batches:
            for at in range(0, b.num_rows, slice_rows):
                part = b.slice(at, slice_rows)
                texts = [model.decode(v.values.to_numpy(zero_copy_only=False).tolist() if v.is_valid else ()) for v in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string())], names=[id_col, "ids", "text"])

    rows = encoded.select(F.col(id_col), F.col(ids_col).cast("array<int>").alias("ids"))
    return rows.mapInArrow(run, f"`{id_col}` {rows.dtypes[0][1]}, ids array<int>, text string")


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", slice_rows: int = 256) -> DataFrame:
    """``(id_col, ids, text)``: each text encoded, and its ids decoded again, by
    one worker with one model in memory. Null and empty texts: no ids, the empty
    text. Repeated rows: each its own row. No rows: no result. Other columns are
    ignored."""
    shared = _share(docs, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(shared)
        for b in batches:
            for at in range(0, b.num_rows, slice_rows):
                part = b.slice(at, slice_rows)
                ids, ends, texts = array("i"), [0], []
                for text in part.column(1):
                    own = model.encode(text.as_py() or "")
                    texts.append(model.decode(own))
                    ids.extend(own)
                    ends.append(len(ids))
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(ids, np.int32) if ids else [], pa.int32()))
                yield pa.RecordBatch.from_arrays([part.column(0), lists, pa.array(texts, pa.string())], names=[id_col, "ids", "text"])

    rows = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"`{id_col}` {rows.dtypes[0][1]}, ids array<int>, text string")


def digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each text encoded and its ids decoded again, as digests: ``id_col``,
    ``n_tokens``, ``ids_sha256`` (decimal ids joined by commas), ``decoded_sha256``.

    A text passes piece by piece (each is encoded, written into the one digest,
    decoded, and written into the other), so a text of any length takes constant
    memory beside itself. Null and empty texts: no tokens, the digests of nothing.
    Repeated rows: each its own row. No rows: no result. Other columns are ignored.
    """
    shared = _share(docs, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(shared)
        for b in batches:
            counts, id_digests, text_digests = [], [], []
            for text in b.column(1):
                n, ids_hash, text_hash, machine, tail = 0, hashlib.sha256(), hashlib.sha256(), Decoder(model), b""
                for ids in model.pieces(text.as_py() or ""):
                    n += len(ids)
                    numbers = tail + model.decimals(ids)
                    ids_hash.update(numbers[:-1])
                    tail = numbers[-1:]  # no comma after the last id
                    text_hash.update(machine.feed(ids).encode())
                text_hash.update(machine.end().encode())
                counts.append(n)
                id_digests.append(ids_hash.hexdigest())
                text_digests.append(text_hash.hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(counts, pa.int64()), pa.array(id_digests, pa.string()), pa.array(text_digests, pa.string())],
                                             names=[id_col, "n_tokens", "ids_sha256", "decoded_sha256"])

    rows = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"`{id_col}` {rows.dtypes[0][1]}, n_tokens long, ids_sha256 string, decoded_sha256 string")
