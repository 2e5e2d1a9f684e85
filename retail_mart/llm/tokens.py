"""Token-id output: encode whole texts, write sharded token files, read them back.

Documents are range-partitioned and sorted by id (null ids first, equal ids
by a hash of their text), each partition is encoded and written as one shard
of patched frame-of-reference blocks (``token_blocks``), and a manifest names
the shards that count: a task that is repeated writes under a new name, and
what a lost attempt left is in no manifest.

Parts of a text are encoded once and remembered: the tokenizer drops white
space and splits there, and also where a letter and another sign meet, so a
text's ids are its parts' ids in a row. A text holding a special token's string is encoded whole, and so
is every text where the tokenizer's normalizer or splits are others than those this rests on.

Edge cases: a null or empty text is its end id alone; repeated rows and equal
ids are documents of their own; an empty table gives no shards; other columns
are ignored.
"""

from __future__ import annotations

import json
import struct
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from retail_mart.llm import files
from retail_mart.llm.common import cut, run_dir
from retail_mart.llm.token_blocks import ShardReader, ShardWriter

END_ID = 1
# Parts remembered by a worker, in each of two generations; results do not depend on it.
MEMO = 600_000
_BLANKS = bytes.maketrans(b"\n\t\r", b"   ")
# 1: letters, 2: other signs; digits, blanks, controls and the apostrophe, which may begin a suffix, are 0.
_KIND = np.array([1 if b >= 128 or chr(b).isalpha() else 2 if 33 <= b < 127 and not chr(b).isalnum() and b != 39 else 0
                  for b in range(256)], np.int8)
# Lead and further bytes of U+00C0 to U+017F, all of them letters but two.
_LATIN = bytes([*range(128), 0xC3, 0xC4, 0xC5, *range(0x80, 0xC0)])
# Bytes of words that are split no further, if they hold none of the three signs below.
_LETTERS = bytes(b for b in _LATIN if b >= 128 or chr(b).isalpha())
# The characters that stand for bytes in a byte-level vocabulary.
_SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE_CHARS = dict(zip([b for b in range(256) if b not in _SHOWN], range(256, 512), strict=False))
_BYTE_LEVEL = [{"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]
# The normalizer and the splits of a tokenizer whose parts may be encoded apart.
_NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def spaced(raw: bytes) -> bytes:
    """``raw`` with a blank wherever a letter and another sign meet: the
    tokenizer always splits there. Texts with other characters than ASCII and
    Latin letters are left as they are, as are those with U+0130, which the
    tokenizer lowers to a letter and a mark."""
    if raw.translate(None, _LATIN) or b"\xc3\x97" in raw or b"\xc3\xb7" in raw or b"\xc4\xb0" in raw:
        return raw
    b = np.frombuffer(raw, np.uint8)
    kind = _KIND[b]
    at = np.flatnonzero(kind[1:] + kind[:-1] == 3) + 1
    at = at[(kind[at] != 0) & (kind[at - 1] != 0)]
    return np.insert(b, at, 32).tobytes() if len(at) else raw


class Memo(dict):
    """Parts and their ids in two generations; a part in neither is coded when it is looked up."""

    def __init__(self, code):
        super().__init__()
        self.code, self.older = code, {}

    def age(self) -> None:
        if len(self) > MEMO:
            self.older = dict(self)
            self.clear()

    def __missing__(self, part: bytes) -> bytes:
        known = self.older.get(part)
        self[part] = known = self.code(part) if known is None else known
        return known


class Encoder:
    """The tokenizer with a memory of encoded parts; ids as little-endian u32 bytes."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        splits = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        self.in_parts = ((spec.get("normalizer") or {}).get("normalizers") == _NORMALIZERS
                         and splits[0].get("pattern") == {"Regex": _SPLIT} and splits[0].get("behavior") == "Removed" and splits[0].get("invert") is True)
        self.special = [t.content.encode().lower() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.words = self.in_parts and splits[1:] == _BYTE_LEVEL
        self.memo = Memo(self.code)

    def code(self, part: bytes) -> bytes:
        """Ids of one part; a word of letters is one split and goes to the tokenizer's model as it is."""
        if self.words and not part.translate(None, _LETTERS) and part and b"\xc3\x97" not in part and b"\xc3\xb7" not in part and b"\xc4\xb0" not in part:
            word = part.decode() if part.isascii() else part.decode().lower().encode().decode("latin-1").translate(_BYTE_CHARS)
            ids = [t.id for t in self.tokenizer.model.tokenize(word)]
        else:
            ids = self.tokenizer.encode(part.decode(), add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def ids(self, text: str | None) -> np.ndarray:
        """Ids of the whole text without special tokens, and the end id."""
        raw = (text or "").encode().lower()  # lowers ASCII only, as the tokenizer would
        if not self.in_parts or any(s in raw for s in self.special):
            own = np.array(self.tokenizer.encode(text or "", add_special_tokens=False).ids, "<u4").tobytes()
        else:
            self.memo.age()
            own = b"".join(map(self.memo.__getitem__, spaced(raw.translate(_BLANKS)).split(b" ")))
        return np.append(np.frombuffer(own, "<u4"), np.uint32(END_ID))


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    """A worker's encoder: its tokenizer and memory serve all tasks of that worker."""
    return Encoder(path)


def write_tokens(documents: DataFrame, tokenizer: str, folder: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Write the shards below ``folder``; the manifest (shard, path, documents, tokens), itself stored."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        shard = TaskContext.get().partitionId()
        ids, out, path = None, None, f"{folder}/shard-{shard:06d}-{uuid.uuid4().hex}.tkpf"
        for b in batches:
            for d, body in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                if out is None:
                    ids, out = encoder(tokenizer).ids, ShardWriter(files.create(path))
                out.add(d, ids(body.as_py()))
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"shard": [shard], "path": [path], "documents": [len(out.docs)], "tokens": [out.tokens]})

    d = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    tie = F.xxhash64("text")
    ordered = d.repartitionByRange(F.col("doc_id"), tie).sortWithinPartitions("doc_id", tie)
    return cut(ordered.mapInArrow(write, "shard long, path string, documents long, tokens long"))


def read_tokens(manifest: DataFrame) -> DataFrame:
    """One row per document, from the files: (doc_id, start, n_tokens, ids_crc32)."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, base in zip(b.column("path").to_pylist(), b.column("base").to_pylist(), strict=True):
                with files.open_at(path) as f:
                    r = ShardReader(f)
                    crc = np.fromiter(r.crcs(), np.int64, len(r.docs))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(r.docs["id"], mask=r.docs["has_id"] == 0), pa.array(r.docs["start"].astype(np.int64) + base),
                         pa.array(r.docs["n"].astype(np.int64)), pa.array(crc)], ["doc_id", "start", "n_tokens", "ids_crc32"])

    # the manifest has a row per shard
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    m = manifest.withColumn("base", F.coalesce(F.sum("tokens").over(before), F.lit(0)))
    n = max(1, manifest.count())
    return m.repartition(n, "shard").mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def encode_corpus(documents: DataFrame, tokenizer: str, folder: str | None = None) -> DataFrame:
    """Write ``documents`` as token shards and return what the files hold, per document."""
    return read_tokens(write_tokens(documents, tokenizer, folder or run_dir(documents.sparkSession, "tokens")))
