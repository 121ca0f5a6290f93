"""Token-id files (operator 6).

Documents are range-partitioned and sorted by id (null first, ties by text),
tokenised, and an end id follows each.  A part's id stream is cut into frames
of whole documents (about FRAME_BLOCKS blocks), and a frame into blocks of
BLOCK_IDS ids, each coded by the range coder from the state that its frame's
prior gives, and carrying a CRC-32 of its ids.  A frame is one binary value:

    magic "TIDF", version u8, u32 documents, u32 blocks, u32 bytes of the prior,
    i64 ids and u8 null marks of the documents, u32 ids per document,
    per block: u32 ids, u32 bytes, u32 crc32;  the prior;  the blocks' bytes

(little-endian).  Frames are written by Spark as rows (part, frame, n_docs,
n_ids, data) of a Parquet table in the shared folder, so a lost task is simply
written again.  Reading decodes frames independently and checks every block;
a wrong checksum raises.  Where each frame starts in the whole id sequence
follows from the small columns alone: a running sum within a part, and over
the parts (one row a part).

Cases: null and empty texts hold the end id alone; repeated rows and tied ids
each have their own entry; special-token strings inside a text are encoded as
the tokenizer does by default; very long texts make a large frame; an empty
table gives an empty one; other columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from array import array
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tandem.llm.common import documents, join_small, python_ready
from tandem.llm.range_coder import Prior, decode, encode
from tandem.session import scratch_path

TOKENIZER = "byte_bpe_50k.json"
END_ID = 0
BLOCK_IDS, FRAME_BLOCKS = 2048, 1024
#: Blocks coded in step with one another in a task.
LANES = 4096
#: Frames that are decoded together at most.
FRAMES = 32
#: Characters of text that are cut in one step.
TEXT_STEP = 1 << 21
#: Pre-tokens whose ids a worker keeps at most (about 200 bytes each).
KEPT_PIECES = 1_000_000
_MAGIC = b"TIDF"
_HEAD = struct.Struct("<4sBIII")


def tokenizer(name: str = TOKENIZER):
    import public_tokenizers
    from tokenizers import Tokenizer
    return Tokenizer.from_file(public_tokenizers.path(name))


class Encoder:
    """The library's ids of whole texts, encoding each distinct pre-token once
    while it is kept.  That equals encoding the text where the tokenizer has
    no normaliser and a byte-level pre-tokeniser with its own pattern; others,
    and texts holding a special token's string, go to the library as they are."""

    def __init__(self, name: str = TOKENIZER, kept: int = KEPT_PIECES):
        import json
        self.tok, self.kept = tokenizer(name), kept
        spec = json.loads(self.tok.to_str())
        pre = spec["pre_tokenizer"] or {}
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.piecewise = spec["normalizer"] is None and pre.get("type") == "ByteLevel" and pre.get("use_regex") \
            and not pre.get("add_prefix_space") and self.tok.get_vocab_size() <= 1 << 16
        self.kinds = _kinds()
        # the library's model alone, for pieces already cut and written in its byte letters
        self.model, self.letters = type(self.tok)(self.tok.model), _byte_letters()
        self._forget()

    def _forget(self) -> None:
        """Nothing kept: numbers of the pieces, all their ids, where each one's end."""
        self.known, self.ids, self.ends = {}, array("H"), array("q", [0])

    def _numbers(self, pieces: list[str]) -> np.ndarray:
        """Numbers of distinct pieces; those not kept are encoded."""
        if len(self.known) > self.kept:
            self._forget()
        found = np.fromiter(map(self.known.get, pieces, repeat(-1)), np.int64, len(pieces))
        missing = np.flatnonzero(found < 0)
        if len(missing):
            new = [pieces[i] for i in missing.tolist()]
            found[missing] = numbers = np.arange(len(self.known), len(self.known) + len(new))
            self.known.update(zip(new, numbers.tolist(), strict=True))
            data = np.frombuffer(b"\xff".join(map(str.encode, new)), np.uint8)  # a byte that UTF-8 never has
            letters = self.letters[data].tobytes().decode("utf-32-le").split("\n")
            coded = self.model.encode(letters, is_pretokenized=True, add_special_tokens=False)
            last = self.ends[-1]
            self.ids.extend(coded.ids)
            size = np.bincount(np.array(coded.word_ids, np.int64), minlength=len(new))
            self.ends.frombytes((last + np.cumsum(size)).astype(np.int64).tobytes())
        return found

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        whole = [not self.piecewise or any(x in t for x in self.special) for t in texts]
        pieces, ends = _cut(["" if w else t for t, w in zip(texts, whole, strict=True)], self.kinds)
        number, piece = self._numbers(pieces.dictionary.to_numpy(zero_copy_only=False).tolist()), pieces.indices.to_numpy()
        kept, all_ids = np.frombuffer(self.ends, np.int64), np.frombuffer(self.ids, np.uint16)
        start = kept[number]
        n = (kept[number + 1] - start).astype(np.int32)[piece]
        n[ends] = 0  # the separators
        to = np.cumsum(n, dtype=np.int64)
        at = np.repeat(start[piece] - (to - n), n)
        at += np.arange(len(at))
        flat = all_ids[at].astype(np.int32)
        del kept, all_ids  # arrays in use cannot grow
        to = to[ends].tolist()
        return [np.array(self.tok.encode(t, add_special_tokens=False).ids, np.int32) if w else flat[a:z]
                for t, w, a, z in zip(texts, whole, [0, *to], to, strict=False)]


def _byte_letters() -> np.ndarray:
    """The letter (code point) that a byte-level model knows each byte by:
    printable ones themselves, the others in turn from 256; a line end for 255."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = np.zeros(256, "<u4")
    letters[plain] = plain
    rest = np.setdiff1d(np.arange(256), plain)
    letters[rest] = 256 + np.arange(len(rest))
    letters[255] = ord("\n")
    return letters


_LETTER, _NUMBER, _SPACE, _SEPARATOR = 1, 2, 3, 4


def _kinds() -> np.ndarray:
    """The pattern's kind of every code point: letter, number, space, other."""
    import regex
    points = np.arange(0x110000, dtype="<u4")
    points[0xD800:0xE000] = 0xE000  # surrogates are in no text
    text, kinds = points.tobytes().decode("utf-32-le"), np.zeros(len(points), np.uint8)
    for kind, pattern in ((_LETTER, r"\p{L}+"), (_NUMBER, r"\p{N}+"), (_SPACE, r"\s+")):
        for m in regex.finditer(pattern, text):
            kinds[m.start():m.end()] = kind
    return kinds


def _cut(texts: list[str], kinds: np.ndarray) -> tuple[pa.DictionaryArray, np.ndarray]:
    """All texts cut by the byte-level pattern
    's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+
    with one separator piece after each text, and where the separators are."""
    joined = "".join(t + "\0" for t in texts)
    data, point = joined.encode(), np.frombuffer(joined.encode("utf-32-le"), "<u4")
    kind = kinds[point]
    after = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1) - 1
    kind[after] = _SEPARATOR
    space, begin = kind == _SPACE, np.ones(len(point), bool)
    # a run of one kind begins a piece, unless the blank before it does so for it;
    # so does the last space before something else
    begin[1:] = (kind[1:] != kind[:-1]) & (space[1:] | (point[:-1] != 32))
    begin[:-1] |= space[:-1] & ~space[1:] & (kind[1:] != _SEPARATOR)
    begin[after] = True
    quote = np.flatnonzero((point == 39) & begin)
    one, two = point[quote + 1], point[np.minimum(quote + 2, len(point) - 1)]
    short = np.isin(one, np.frombuffer(b"stmd", np.uint8))
    long = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
    begin[quote[short | long] + 1] = False
    begin[quote[short] + 2] = True
    begin[quote[long] + 3] = True
    at = np.flatnonzero(begin)
    ends = np.searchsorted(at, after)
    if len(data) != len(point):  # places in UTF-8
        width = (point >= 0x80).astype(np.uint8) + (point >= 0x800) + (point >= 0x10000) + np.uint8(1)
        at = (np.cumsum(width, dtype=np.int64) - width)[at]
    offsets = np.append(at, len(data)).astype(np.int32)
    pieces = pa.StringArray.from_buffers(len(at), pa.py_buffer(offsets), pa.py_buffer(data))
    return pieces.dictionary_encode(), ends


_encoders: dict = {}


def encoder(name: str = TOKENIZER) -> Encoder:
    """One encoder for each tokenizer in a worker process."""
    if name not in _encoders:
        _encoders[name] = Encoder(name)
    return _encoders[name]


def pack_frames(frames: list[tuple[list, list[np.ndarray]]]) -> list[bytes]:
    """Frames from (document ids, id arrays of the documents)."""
    blocks, priors, which = [], [], []
    for f, (_, docs) in enumerate(frames):
        flat = np.concatenate(docs)
        priors.append(Prior.fit(flat))
        cut = [flat[s:s + BLOCK_IDS] for s in range(0, len(flat), BLOCK_IDS)]
        blocks += cut
        which += [f] * len(cut)
    coded = []
    for s in range(0, len(blocks), LANES):
        coded += encode(blocks[s:s + LANES], priors, which[s:s + LANES])
    out, at = [], 0
    for (ids, docs), prior, n in zip(frames, priors, np.bincount(which).tolist(), strict=True):
        mine, code, start = blocks[at:at + n], coded[at:at + n], prior.pack()
        at += n
        head = _HEAD.pack(_MAGIC, 2, len(ids), n, len(start))
        index = np.array([0 if x is None else x for x in ids], "<i8").tobytes() + bytes(x is None for x in ids) \
            + np.array([len(d) for d in docs], "<u4").tobytes()
        table = np.array([[len(b), len(c), zlib.crc32(b.astype("<u4").tobytes())] for b, c in
                          zip(mine, code, strict=True)], "<u4").tobytes()
        out.append(head + index + table + start + b"".join(code))
    return out


def unpack_frames(frames: list[bytes]):
    """For each frame: (document ids, ids per document, all ids)."""
    parsed, coded, lengths, crcs, priors, which = [], [], [], [], [], []
    for f in frames:
        magic, version, n, k, start = _HEAD.unpack_from(f)
        if magic != _MAGIC or version != 2:
            raise ValueError("not a token-id frame")
        at = _HEAD.size
        ids = np.frombuffer(f, "<i8", n, at)
        null = np.frombuffer(f, np.uint8, n, at + 8 * n)
        size = np.frombuffer(f, "<u4", n, at + 9 * n)
        table = np.frombuffer(f, "<u4", 3 * k, at + 13 * n).reshape(k, 3)
        at += 13 * n + 12 * k
        which += [len(priors)] * k
        priors.append(Prior.unpack(f[at:at + start]))
        at += start
        for m, length, crc in table.tolist():
            coded.append(f[at:at + length])
            lengths.append(m)
            crcs.append(crc)
            at += length
        parsed.append(([None if z else int(x) for x, z in zip(ids, null, strict=True)], size, k))
    plain: list = []
    for s in range(0, len(coded), LANES):
        plain += decode(coded[s:s + LANES], lengths[s:s + LANES], priors, which[s:s + LANES])
    for b, crc in zip(plain, crcs, strict=True):
        if zlib.crc32(b.astype("<u4").tobytes()) != crc:
            raise ValueError("a block's checksum is wrong")
    at = 0
    for ids, size, k in parsed:
        yield ids, size, np.concatenate(plain[at:at + k])
        at += k


def _encode_part(name: str, end_id: int):
    def run(batches):
        encode_texts, part = encoder(name), TaskContext.get().partitionId()
        frames, ids, docs, size, number = [], [], [], 0, 0

        def flush():
            nonlocal number
            data = pack_frames(frames)
            yield pa.record_batch([
                pa.array([part] * len(data), pa.int32()), pa.array(range(number, number + len(data)), pa.int32()),
                pa.array([len(i) for i, _ in frames], pa.int64()),
                pa.array([sum(map(len, d)) for _, d in frames], pa.int64()), pa.array(data, pa.binary())],
                ["part", "frame", "n_docs", "n_ids", "data"])
            number += len(data)
            frames.clear()

        for b in batches:
            text, key = b.column("text").to_pylist(), b.column("doc_id").to_pylist()
            at = 0
            while at < len(text):
                to, held = at, 0
                while to < len(text) and (held < TEXT_STEP or to == at):
                    held += len(text[to] or "")
                    to += 1
                for k, e in zip(key[at:to], encode_texts([t or "" for t in text[at:to]]), strict=True):
                    ids.append(k)
                    docs.append(np.append(e, np.int32(end_id)))
                    size += len(docs[-1])
                    if size >= FRAME_BLOCKS * BLOCK_IDS:
                        frames.append((ids, docs))
                        ids, docs, size = [], [], 0
                        if len(frames) * FRAME_BLOCKS >= LANES:
                            yield from flush()
                at = to
        if ids:
            frames.append((ids, docs))
        if frames:
            yield from flush()
    return run


def _decode_part(batches):
    for b in batches:
        full = np.cumsum(np.ceil(b.column("n_ids").to_numpy() / BLOCK_IDS))
        to = 0
        while to < len(b):  # frames that fill the lanes; each also brings its prior
            s, done = to, full[to - 1] if to else 0
            to = min(max(int(np.searchsorted(full, done + LANES, "right")), s + 1), s + FRAMES)
            part = b.slice(s, to - s)
            where = zip(part.column("part").to_pylist(), part.column("frame").to_pylist(), strict=True)
            for (p, f), (ids, size, flat) in zip(where, unpack_frames([x.as_py() for x in part.column("data")]), strict=True):
                end = np.cumsum(size.astype(np.int64))
                raw = flat.astype("<u4")
                crc = [zlib.crc32(raw[a:z].tobytes()) for a, z in zip(end - size, end, strict=True)]
                yield pa.record_batch([pa.array(ids, pa.int64()), pa.array([p] * len(ids), pa.int32()),
                                       pa.array([f] * len(ids), pa.int32()), pa.array(end - size, pa.int64()),
                                       pa.array(size, pa.int64()), pa.array(crc, pa.int64())],
                                      ["doc_id", "part", "frame", "inner", "n_tokens", "ids_crc32"])


def write_token_files(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                      tokenizer_name: str = TOKENIZER, end_id: int = END_ID) -> None:
    narrow = python_ready(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    parts = narrow.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    parts.mapInArrow(_encode_part(tokenizer_name, end_id), "part int, frame int, n_docs long, n_ids long, data binary") \
         .write.option("compression", "none").parquet(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per document: doc_id, start, n_tokens, ids_crc32."""
    table = spark.read.schema("part int, frame int, n_docs long, n_ids long, data binary").parquet(path)
    frames = table.select("part", "frame", "n_ids")
    inside = Window.partitionBy("part").orderBy("frame").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = frames.groupBy("part").agg(F.sum("n_ids").alias("all"))  # one row a file
    parts = parts.select("part", F.coalesce(F.sum("all").over(before), F.lit(0)).alias("base"))
    starts = frames.withColumn("off", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)))
    starts = join_small(starts, parts, ["part"]).select("part", "frame", (F.col("base") + F.col("off")).alias("at"))
    found = table.select("part", "frame", "n_ids", "data").mapInArrow(
        _decode_part, "doc_id long, part int, frame int, inner long, n_tokens long, ids_crc32 long")
    return join_small(found, starts, ["part", "frame"]).select(
        "doc_id", (F.col("at") + F.col("inner")).alias("start"), "n_tokens", "ids_crc32")


def op6_token_files(spark, sf_dir):
    path = scratch_path(spark, "token-files")
    write_token_files(documents(spark, sf_dir), path)
    return read_token_files(spark, path)
