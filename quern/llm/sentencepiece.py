"""SentencePiece encoding that keeps offsets, and decoding.

``Normalizer`` rewrites a text by longest prefix through the model's compiled character map (a double-array
trie of replacements; a model without one has the empty map), escapes and prefixes spaces as the model
asks, and records for every normalised byte the original byte range it came from. Pieces are those of the
normalised text, stretch by stretch, and tile its bytes, so cumulated piece lengths, looked up in that alignment, give each piece's original byte span. A piece
sequence that does not tile the normalised text exactly raises an error, so the normaliser is checked
against the library on every row.

Texts are encoded whole, in tasks, from Arrow batches; nothing is shuffled. The model (0.5 MB) travels
as bytes, so executors need no file.

Defined results: null text is empty and gives no pieces and an empty decoded text; other columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

import contextlib
import functools
import hashlib
import re
import struct
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ._common import table

SPACE = "▁"
STRETCH = re.compile(f"{SPACE}+[^{SPACE}\n]*|\n[^{SPACE}\n]*")
#: Stretches that a worker remembers.
MAX_WORDS = 500_000
MODEL = "piece_bpe_32k.model"


class CharsMap:
    """The compiled map: a length, that many bytes of double-array units, then NUL-ended replacements. An empty one maps nothing."""

    def __init__(self, blob: bytes):
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist() if blob else []
        self.strings = blob[4 + size :]
        begins = [c for c in range(256) if self._child(self._down(0), c) is not None] if self.units else []
        self.begins = re.compile(b"[" + b"".join(b"\\x%02x" % c for c in begins) + b"]") if begins else None

    def _down(self, node: int) -> int:
        return node ^ (self.units[node] >> 10) << ((self.units[node] & 512) >> 6)

    def _child(self, node: int, byte: int) -> int | None:
        node ^= byte
        return node if node < len(self.units) and (self.units[node] & 0x800000FF) == byte else None

    def longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """Length and replacement of the longest key that begins at ``at``."""
        node, found = self._down(0), None
        for k in range(at, len(data)):
            here = self._child(node, data[k])
            if here is None:
                break
            node = self._down(here)
            if self.units[here] >> 8 & 1:
                found = k - at + 1, self.units[node] & 0x7FFFFFFF
        if found is None:
            return None
        return found[0], self.strings[found[1] : self.strings.index(b"\0", found[1])]

    def hits(self, data: bytes) -> Iterator[tuple[int, int, bytes]]:
        """Begin, end and replacement of each key met from left to right; only bytes that begin a key are looked at."""
        at = 0
        while self.begins and (m := self.begins.search(data, at)):
            at = m.start()
            hit = self.longest(data, at)
            if hit:
                yield at, at + hit[0], hit[1]
                at += hit[0]
            else:
                at += 1


class Normalizer:
    """normalise(text) -> normalised bytes, begin and end of each one's source in the text's UTF-8 bytes.

    A byte that no key covers is its own source; all bytes of a replacement have the whole key as theirs.
    """

    def __init__(self, charsmap: bytes = b"", dummy_prefix: bool = True, trim: bool = False, escape: bool = True):
        self.map = CharsMap(charsmap)
        self.dummy_prefix, self.trim = dummy_prefix, trim
        self.space = SPACE.encode() if escape else b" "

    def _mapped(self, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        raw, place = np.frombuffer(data, np.uint8), np.arange(len(data), dtype=np.int32)
        parts, at = [], 0
        for begin, end, new in self.map.hits(data):
            parts.append((raw[at:begin], place[at:begin], place[at:begin] + 1))
            parts.append((np.frombuffer(new, np.uint8), np.full(len(new), begin, np.int32), np.full(len(new), end, np.int32)))
            at = end
        parts.append((raw[at:], place[at:], place[at:] + 1))
        return parts[0] if len(parts) == 1 else tuple(np.concatenate(x) for x in zip(*parts, strict=True))

    def __call__(self, text: str) -> tuple[bytes, np.ndarray, np.ndarray]:
        raw, begin, end = self._mapped(text.encode())
        blank = raw == 32
        if self.trim and len(raw):  # leading, repeated and trailing spaces
            keep = ~blank | np.append(False, ~blank[:-1])
            last = np.flatnonzero(keep)[-1:]
            keep[last] &= ~blank[last]
            raw, begin, end, blank = raw[keep], begin[keep], end[keep], blank[keep]
        if not len(raw):
            return b"", np.zeros(0, np.int32), np.zeros(0, np.int32)
        out = raw.tobytes().replace(b" ", self.space)
        times = np.where(blank, len(self.space), 1)
        begin, end = np.repeat(begin, times), np.repeat(end, times)
        if self.dummy_prefix:
            first = np.full(len(self.space), begin[0], np.int32)
            out, begin, end = self.space + out, np.concatenate([first, begin]), np.concatenate([first, end])
        return out, begin, end


class Words:
    """Packed ids of stretches of normalised text that begin at a space or a line break: what was asked for lately is remembered."""

    def __init__(self, model):
        self.model = model
        self.known: dict[str, bytes] = {}
        self.again: set[str] = set()  # asked for in more than one call
        self.space = array("i", [model.piece_to_id(SPACE)]).tobytes()

    def learn(self, stretches: set[str]) -> dict[str, bytes]:
        """A table that holds all of ``stretches``; those it lacked are encoded in one call."""
        if len(self.known) > MAX_WORDS:
            self.known = {s: self.known[s] for s in (self.again | stretches) & self.known.keys()}
            if len(self.known) > MAX_WORDS // 2:  # too many come again: begin with those of this call
                self.known, self.again = {s: self.known[s] for s in stretches & self.known.keys()}, set()
        self.again |= stretches & self.known.keys()
        new = list(stretches - self.known.keys())
        # the library puts a space in front: it stands for the stretch's own, or is dropped before a line break
        ids = self.model.encode([s.removeprefix(SPACE).replace(SPACE, " ") for s in new], num_threads=1) if new else []
        for s, got in zip(new, ids, strict=True):
            self.known[s] = self.space if s == SPACE else array("i", got if s[0] == SPACE else got[1:]).tobytes()
        return self.known

    def forget(self) -> None:
        self.known, self.again = {}, set()


class Codec:
    """A model with its normaliser; one per Python worker and model.

    A merge never joins a character to a space after it, nor a line break to anything, if no piece of the
    vocabulary does; then the stretches between are encoded apart (and remembered), with the same ids
    as the whole text. Vocabularies and texts for which that doesn't hold are encoded whole.
    """

    def __init__(self, model: bytes):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(model)
        spec = proto.normalizer_spec
        self.normalise = Normalizer(spec.precompiled_charsmap, spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces)
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        kinds = sentencepiece_model_pb2.ModelProto.SentencePiece
        if not proto.trainer_spec.byte_fallback:
            raise ValueError("a model with byte fallback is needed: its pieces always tile the text")
        pieces = [p.piece for p in proto.pieces if p.type != kinds.BYTE]
        inside = any(SPACE in p.lstrip(SPACE) or "\n" in p for p in pieces)
        plain = not spec.precompiled_charsmap and spec.add_dummy_prefix and not spec.remove_extra_whitespaces and spec.escape_whitespaces
        self.by_stretch = plain and not inside and not any(p.type == kinds.USER_DEFINED for p in proto.pieces)
        self.words = Words(self.model)
        self.lengths = np.array([1 if p.type == kinds.BYTE else len(p.piece.encode()) for p in proto.pieces], np.int32)

    def ids(self, texts: list[str], normal: list[bytes]) -> list[np.ndarray]:
        apart = [self.by_stretch and t != "" and SPACE not in t for t in texts]
        stretches = [STRETCH.findall(n.decode()) if a else [] for n, a in zip(normal, apart, strict=True)]
        known = self.words.learn(set().union(*stretches))
        return [
            np.frombuffer(b"".join([known[s] for s in parts]), np.int32) if a else np.array(self.model.encode(t), np.int32)
            for t, a, parts in zip(texts, apart, stretches, strict=True)
        ]

    def spans(self, ids: np.ndarray, normal: bytes, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Begin and end of each piece in the text's UTF-8 bytes: pieces tile the normalised text, which knows its sources."""
        lengths = self.lengths[ids]
        stops = np.cumsum(lengths)
        covered = int(stops[-1]) if len(stops) else 0
        if covered != len(normal):
            raise ValueError(f"pieces cover {covered} of {len(normal)} normalised bytes")
        return begin[stops - lengths], end[stops - 1]

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """ids, begins and ends for each text: normalised first, then cut into pieces, then projected back."""
        normal = [self.normalise(t) for t in texts]
        return [(ids, *self.spans(ids, *n)) for n, ids in zip(normal, self.ids(texts, [n[0] for n in normal]), strict=True)]

    def decode(self, ids: np.ndarray) -> str:
        return self.model.decode(ids.tolist())


@functools.lru_cache(maxsize=4)
def codec(model: bytes) -> Codec:
    return Codec(model)


@contextlib.contextmanager
def one_task(model: bytes) -> Iterator[Codec]:
    """The worker's codec for one task. Idle workers stay beside later stages, so what was remembered goes with the task."""
    sp = codec(model)
    try:
        yield sp
    finally:
        sp.words.forget()
        pa.default_memory_pool().release_unused()


def read_model(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


OUT = "doc_id {id}, ids array<int>, begins array<int>, ends array<int>, decoded string"


def encode(docs: DataFrame, model: bytes) -> DataFrame:
    """doc_id, ids, byte spans [begins, ends) of the original text, and the text decoded from the ids."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with one_task(shared.value) as sp:
            for batch in batches:
                # a few rows at a time: an id list is several times its text
                for low in range(0, batch.num_rows, 256):
                    part = batch.slice(low, 256)
                    rows = sp.encode([t or "" for t in part.column("text").to_pylist()])
                    offsets = pa.array(np.cumsum([0, *(len(r[0]) for r in rows)]), pa.int32())
                    lists = [pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([r[k] for r in rows]), pa.int32())) for k in range(3)]
                    decoded = pa.array([sp.decode(r[0]) for r in rows], pa.string())
                    yield pa.RecordBatch.from_arrays([part.column("doc_id"), *lists, decoded], ["doc_id", "ids", "begins", "ends", "decoded"])

    return docs.select("doc_id", "text").mapInArrow(run, OUT.format(id=id_type))


DIGESTS = "doc_id {id}, n_tokens long, ids_sha256 string, decoded_sha256 string, begins binary, ends binary, bytes_covered int"


def digests(docs: DataFrame, model: bytes) -> DataFrame:
    """doc_id, n_tokens, digests of the ids and the decoded text, and the pieces' byte spans packed as unsigned 32-bit numbers: what :func:`encode` gives, summed up where it is made."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sp = codec(shared.value)
        said = pa.array([f"{i}," for i in range(len(sp.lengths))])
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part, rows = batch.slice(low, 256), []
                for ids, begins, ends in sp.encode([t or "" for t in part.column("text").to_pylist()]):
                    text = said.take(pa.array(ids, pa.int32())).buffers()[2]
                    digest = [hashlib.sha256(x).hexdigest() for x in (text.to_pybytes()[:-1] if text else b"", sp.decode(ids).encode())]
                    rows.append((len(ids), *digest, begins.astype("<u4").tobytes(), ends.astype("<u4").tobytes(), int(ends[-1]) if len(ends) else 0))
                kinds = [pa.int64(), pa.string(), pa.string(), pa.binary(), pa.binary(), pa.int32()]
                columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *columns], [f.split()[0] for f in DIGESTS.split(", ")])

    return docs.select("doc_id", "text").mapInArrow(run, DIGESTS.format(id=id_type))


def op8_piece_offsets(spark: SparkSession, sf_dir: str, model_path: str | None = None) -> DataFrame:
    import public_tokenizers

    return digests(table(spark, sf_dir, "documents"), read_model(model_path or public_tokenizers.path(MODEL)))


QUERIES = {"op8_piece_offsets": op8_piece_offsets}
ORACLE: dict[str, str] = {}
