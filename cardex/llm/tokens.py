"""Operator 8: token ids in binary files.

Documents are ranged by their order, encoded with a public tokenizer and written by
Spark's own writer, so that any shared store and any retry works.  A file holds one
block: its documents' keys and lengths, the block's ids from the most to the least
frequent, and the ids' ranks in a byte-aligned code of variable length.  The code keeps
control and data bytes apart: two bits say how many bytes a rank takes, four of them
share a control byte, and a table indexed by control bytes yields the lengths of four
ranks at once.
"""

from __future__ import annotations

import json
import re
import struct
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType
from pyspark.sql.window import Window

from cardex.llm import arrays
from cardex.llm.common import store
from cardex.session import scratch_dir

TOKENIZER = "word_bpe_49k.json"
END_ID = 1
_END = array("I", [END_ID]).tobytes()
# Bytes of text of a block (one document more at most).
BLOCK_BYTES = 8 * 1024 * 1024
# Bytes of text encoded at a time (one document more at most).
SLICE_BYTES = 4 * 1024 * 1024
# Words whose ids a worker remembers.
REMEMBERED = 400_000

MAGIC = b"CXTOK1\x00\n"
# partition, number in the partition, documents, tokens, distinct ids, data bytes
_HEADER = struct.Struct("<8s6q")

# Words that fall into pieces of plain letters, digits and marks.
_PLAIN = re.compile(r"[!-~ß-öø-ÿ]+")
_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-z0-9ß-öø-ÿ]+")


# The parts of a tokenizer whose texts may be encoded word by word.
_BY_WORDS = {
    "normalizer": {
        "type": "Sequence",
        "normalizers": [
            {"type": "NFC"},
            {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
            {"type": "Lowercase"},
        ],
    },
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {
                "type": "Split",
                "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
                "behavior": "Removed",
                "invert": True,
            },
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
}


def by_words(settings: dict) -> bool:
    """Whether a tokenizer, given by its file's content, never joins two words.

    Known for one normaliser with one splitter, for a model without chance whose special
    tokens begin with a mark that no other piece holds.
    """
    model = settings["model"]
    return (
        all(settings.get(part) == known for part, known in _BY_WORDS.items())
        and model.get("type") == "BPE"
        and not model.get("dropout")
        and all(t["content"].startswith("<|") and not t["normalized"] for t in settings["added_tokens"])
    )


def _byte_characters() -> dict[int, str]:
    """The characters that stand for bytes in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + n) for n, b in enumerate(hidden)}


_BYTES = _byte_characters()


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


# -- the code ---------------------------------------------------------------------


# For each control byte the lengths of its four numbers.
LENGTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3) + 1


def encode_numbers(numbers: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of non-negative numbers below 2 ** 32."""
    numbers = numbers.astype("<u4")
    lengths = 1 + (numbers > 0xFF) + (numbers > 0xFFFF) + (numbers > 0xFFFFFF)
    padded = np.zeros(-(-len(numbers) // 4) * 4, np.uint8)
    padded[: len(numbers)] = lengths - 1
    control = (padded.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(axis=1).astype(np.uint8)
    kept = np.arange(4)[None, :] < lengths[:, None]
    return control.tobytes(), numbers.view(np.uint8).reshape(-1, 4)[kept].tobytes()


def decode_numbers(control: np.ndarray, data: np.ndarray, count: int) -> np.ndarray:
    """The numbers again: lengths by table, then one gather per byte of a number."""
    lengths = LENGTHS[control].reshape(-1)[:count]
    starts = np.concatenate([[0], np.cumsum(lengths)])[:-1]
    numbers = data[starts].astype(np.uint32)
    for place in range(1, 4):
        longer = np.flatnonzero(lengths > place)
        if not len(longer):
            break
        numbers[longer] |= data[starts[longer] + place].astype(np.uint32) << np.uint32(8 * place)
    return numbers


def encode_block(partition: int, number: int, keys: list[bytes | None], counts: np.ndarray, ids: np.ndarray) -> bytes:
    """A file's bytes: header, keys, token counts, ids by frequency, control, data."""
    seen = np.bincount(ids)
    order = np.argsort(-seen, kind="stable")[: np.count_nonzero(seen)]
    rank = np.zeros(len(seen), np.uint32)
    rank[order] = np.arange(len(order), dtype=np.uint32)
    control, data = encode_numbers(rank[ids])
    named = b"".join(struct.pack("<i", -1 if k is None else len(k)) + (k or b"") for k in keys)
    head = _HEADER.pack(MAGIC, partition, number, len(keys), len(ids), len(order), len(data))
    lengths = counts.astype("<i8").tobytes()
    return b"".join([head, struct.pack("<q", len(named)), named, lengths, order.astype("<u4").tobytes(), control, data])


def read_header(content: bytes) -> tuple[int, int, int, int]:
    """Partition, number, documents and tokens of a block."""
    magic, partition, number, documents, tokens, _, _ = _HEADER.unpack_from(content)
    if magic != MAGIC:
        raise ValueError("not a file of token ids")
    return partition, number, documents, tokens


def decode_block(content: bytes) -> tuple[list[bytes | None], np.ndarray, np.ndarray]:
    """Keys, token counts and all ids of a block."""
    magic, _, _, documents, tokens, distinct, size = _HEADER.unpack_from(content)
    if magic != MAGIC:
        raise ValueError("not a file of token ids")
    at = _HEADER.size + 8
    (named,) = struct.unpack_from("<q", content, _HEADER.size)
    keys, place = [], at
    for _ in range(documents):
        (length,) = struct.unpack_from("<i", content, place)
        keys.append(None if length < 0 else content[place + 4 : place + 4 + length])
        place += 4 + max(length, 0)
    at += named
    counts = np.frombuffer(content, "<i8", documents, at)
    at += 8 * documents
    table = np.frombuffer(content, "<u4", distinct, at)
    at += 4 * distinct
    control = np.frombuffer(content, np.uint8, -(-tokens // 4), at)
    data = np.frombuffer(content, np.uint8, size, at + len(control))
    return keys, counts, table[decode_numbers(control, data, tokens)]


# -- the tokenizer ----------------------------------------------------------------


class Encoder:
    """Ids of texts, the same as encoding each text whole, with words remembered.

    A tokenizer that ``by_words`` knows never joins characters across white space, and
    it lower-cases.  So a text's ids are those of its words; words of plain Latin
    letters, digits and marks fall into pieces that its model encodes one by one.  Other
    words are encoded by the tokenizer itself, and so is a whole text in which a special
    token may stand.  Any other tokenizer gets all texts whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # whole texts, whatever the file says
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.by_words = by_words(json.loads(self.tokenizer.to_str()))
        self.model = self.tokenizer.model
        # ids as bytes of unsigned 32-bit integers, so that many join at once
        self.known: dict[bytes, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    def _piece(self, piece: str) -> bytes:
        shown = piece if piece.isascii() else "".join(_BYTES[b] for b in piece.encode())
        found = self.pieces[piece] = array("I", [t.id for t in self.model.tokenize(shown)]).tobytes()
        return found

    def _remember(self, words: list[bytes]) -> None:
        others, pieces = [], self.pieces
        for word in words:
            text = word.decode()
            if not text.isascii():
                text = text.lower()
            if _PLAIN.fullmatch(text):
                parts = [pieces.get(p) or self._piece(p) for p in _PIECES.findall(text)]
                self.known[word] = parts[0] if len(parts) == 1 else b"".join(parts)
            else:
                others.append(word)
        if others:
            self.known.update(zip(others, self._joined([w.decode() for w in others])))

    def _joined(self, words: list[str]) -> list[bytes]:
        """Ids of words encoded as one text, told apart by their places in it."""
        encoded = self.tokenizer.encode("\n".join(words), add_special_tokens=False)
        ends = np.cumsum([len(w) + 1 for w in words])
        starts = np.array([start for start, _ in encoded.offsets], np.int64)
        cuts = np.searchsorted(starts, ends)
        ids = np.array(encoded.ids, np.uint32)
        return [part.tobytes() for part in np.split(ids, cuts[:-1])]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, each text's with the end id last, and how many each text has."""
        if not self.by_words:
            return self._whole(texts)
        special = pc.match_substring(texts, "<|").to_numpy(zero_copy_only=False)
        plain = pc.if_else(pa.array(~special), texts, "") if special.any() else texts
        flat, places = arrays.words(_parted(pc.ascii_lower(plain)))
        codes, distinct = arrays.codes(flat)
        words = _byte_strings(distinct)
        if len(self.known) > REMEMBERED:
            self.known.clear()
        if len(self.pieces) > REMEMBERED:
            self.pieces.clear()
        known = self.known
        self._remember([w for w in words if w not in known])
        per_word = [*map(known.__getitem__, words), _END]
        # the end id behind each text's last word
        flow = np.insert(codes, places[1:], len(words))
        ids = np.frombuffer(b"".join(map(per_word.__getitem__, flow.tolist())), np.uint32)
        sizes = np.fromiter(map(len, per_word), np.int64, len(per_word)) // 4
        counts = arrays.sums(sizes[codes], places) + 1
        return self._with_whole(texts, special, ids, counts) if special.any() else (ids, counts)

    def _whole(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        found = self.tokenizer.encode_batch(texts.to_pylist(), add_special_tokens=False)
        parts = [np.array([*e.ids, END_ID], np.uint32) for e in found]
        return np.concatenate(parts), np.array([len(p) for p in parts], np.int64)

    def _with_whole(self, texts, special, ids, counts) -> tuple[np.ndarray, np.ndarray]:
        marked = texts.filter(pa.array(special)).to_pylist()
        whole = iter(self.tokenizer.encode_batch(marked, add_special_tokens=False))
        parts = np.split(ids, np.cumsum(counts)[:-1])
        parts = [np.array([*next(whole).ids, END_ID], np.uint32) if own else p for own, p in zip(special, parts)]
        return np.concatenate(parts), np.array([len(p) for p in parts], np.int64)


def _byte_strings(values: pa.Array) -> list[bytes]:
    data, places = arrays.text_bytes(values)
    held, cuts = data.tobytes(), places.tolist()
    return [held[a:b] for a, b in zip(cuts, cuts[1:])]


_LETTERS, _STOPS, _GAPS = (np.isin(np.arange(256), list(c)) for c in (range(97, 123), b".,", b" \t\n\x0b\x0c\r"))


def _parted(texts: pa.Array) -> pa.Array:
    """The texts with a space before a stop or comma between a letter and white space.

    There the tokenizer begins a new piece anyway, and far fewer words are distinct.
    """
    data, places = arrays.text_bytes(texts)
    if len(data) < 2:
        return texts
    # a text's last character is followed by the next text's first, which is no matter:
    # it stays with its word then
    found = np.flatnonzero(_STOPS[data[1:-1]] & _LETTERS[data[:-2]] & _GAPS[data[2:]]) + 1
    # of a text's own characters only
    owner = np.searchsorted(places, found, side="right") - 1
    own = (found > places[owner]) & (found + 1 < places[owner + 1])
    found = found[own]
    moved = places + np.searchsorted(found, places, side="left")
    buffers = [None, pa.py_buffer(moved.astype(np.int32)), pa.py_buffer(np.insert(data, found, 32))]
    return pa.Array.from_buffers(pa.string(), len(texts), buffers)


# Of the worker's process, which handles many tasks: what it remembers stays.
_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


# -- files ------------------------------------------------------------------------


def _blocks(path: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, partition, number = encoder(path), TaskContext.get().partitionId(), 0
        keys, counts, ids, size = [], [], [], 0

        def block() -> pa.RecordBatch:
            content = encode_block(partition, number, keys, np.concatenate(counts), np.concatenate(ids))
            return pa.RecordBatch.from_arrays([pa.array([content], pa.binary())], ["content"])

        for batch in batches:
            for part in arrays.slices(batch, "_text", SLICE_BYTES):
                texts = arrays.filled(part["_text"])
                found, lengths = own.encode(texts)
                keys += [None if k is None else k.encode() for k in part["_key"].to_pylist()]
                counts.append(lengths)
                ids.append(found)
                size += texts.nbytes
                if size >= BLOCK_BYTES:
                    yield block()
                    keys, counts, ids, size, number = [], [], [], 0, number + 1
        if keys:
            yield block()

    return run


def write_tokens(
    documents: DataFrame,
    path: str,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    order: list[Column] | None = None,
) -> None:
    """Write the ids of all documents below ``path``, in the order of ``order``.

    The default order is ascending by ``id_col``, NULL first, and by text among rows
    of one id.  NULL and empty texts have only the end id; repeated rows are each
    written; other columns are ignored; an empty table makes no file with content.
    """
    order = order or [F.col(id_col)]
    places = [f"_place{i}" for i in range(len(order))]
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    source = documents.select(
        F.col(id_col).cast("string").alias("_key"), text.alias("_text"), *(c.alias(p) for c, p in zip(order, places))
    )
    keys = [*places, F.xxhash64("_text")]
    (
        source.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .select("_key", "_text")
        .mapInArrow(_blocks(tokenizer), StructType([StructField("content", BinaryType())]))
        .select(F.col("content").cast("string"))
        .write.option("maxRecordsPerFile", 1)
        .text(path)
    )


def _files(spark: SparkSession, path: str) -> DataFrame:
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "part-*")
        .load(path)
        .where("length > 0")
        .select("content")
    )


def block_starts(spark: SparkSession, path: str) -> DataFrame:
    """``partition, number, start``: how many ids precede each file's, from the headers."""
    names = ["partition", "number", "documents", "tokens"]
    schema = StructType([StructField(name, LongType()) for name in names])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [read_header(content.as_buffer()) for content in batch["content"]]
            yield pa.RecordBatch.from_pylist([dict(zip(names, row)) for row in found], pa.schema([(n, pa.int64()) for n in names]))

    heads = _files(spark, path).select(F.substring("content", 1, _HEADER.size).alias("content")).mapInArrow(run, schema)
    return _starts(heads)


def _starts(heads: DataFrame) -> DataFrame:
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    within = heads.select(
        "partition",
        "number",
        F.coalesce(F.sum("tokens").over(before.partitionBy("partition").orderBy("number")), F.lit(0)).alias("_own"),
    )
    # a row for each partition of the write, not for each file
    ahead = (
        heads.groupBy("partition")
        .agg(F.sum("tokens").alias("_tokens"))
        .select("partition", F.coalesce(F.sum("_tokens").over(before.orderBy("partition")), F.lit(0)).alias("_ahead"))
    )
    return within.join(ahead, "partition").select("partition", "number", (F.col("_own") + F.col("_ahead")).alias("start"))


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """``partition, number, place, key, ids``: every document of the files.

    ``place`` counts the ids before it in its file, ``key`` is the id as text, ``ids``
    are little-endian unsigned 32-bit integers with the end id last.
    """
    schema = StructType(
        [
            *(StructField(name, LongType()) for name in ("partition", "number", "place")),
            *StructType().add("key", "string").add("ids", "binary"),
        ]
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch["content"]:
                raw = content.as_buffer()
                partition, number, _, _ = read_header(raw)
                keys, counts, ids = decode_block(memoryview(raw))
                data = ids.astype("<u4").view(np.uint8)
                places = np.concatenate([[0], np.cumsum(counts)])
                # in parts, as ids take several times the bytes of their file
                for first in range(0, len(keys), 1000):
                    last = min(first + 1000, len(keys))
                    own = [data[4 * s : 4 * e].tobytes() for s, e in zip(places[first:last], places[first + 1 : last + 1])]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(last - first, partition)),
                            pa.array(np.full(last - first, number)),
                            pa.array(places[first:last]),
                            pa.array([None if k is None else bytes(k).decode() for k in keys[first:last]], pa.string()),
                            pa.array(own, pa.binary()),
                        ],
                        schema.names,
                    )

    return _files(spark, path).mapInArrow(run, schema)


def token_digest(spark: SparkSession, path: str, id_col: str = "doc_id", id_type: str = "bigint") -> DataFrame:
    """``id_col, start, n_tokens, ids_crc32`` of every document, from the files alone."""
    digests = read_tokens(spark, path).select(
        F.col("key").cast(id_type).alias(id_col),
        "partition",
        "number",
        "place",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )
    # stored, so that the files are decoded once for the rows and for what precedes them
    digests = store(spark, digests, "digests")
    sizes = digests.groupBy("partition", "number").agg(F.sum("n_tokens").alias("tokens"))
    return digests.join(_starts(sizes), ["partition", "number"]).select(
        id_col, (F.col("start") + F.col("place")).alias("start"), "n_tokens", "ids_crc32"
    )


def op8_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of ``documents`` written in ascending order of ``doc_id`` and read back."""
    path = scratch_dir(spark, "tokens")
    write_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"), path, tokenizer_path())
    return token_digest(spark, path)
