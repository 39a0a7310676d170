"""Token ids in directly addressable codes (DAC).

An id is cut into chunks of eight bits. Level k holds the k-th chunk of every id that has one, with a bitmap that says
for each whether the id goes on, and a directory of the bitmap's ones before every 512 bits. Token i is found by rank
alone: its chunk on level 0, then at position rank(i) on level 1, and so on; no block is decoded.

File, little-endian, every section padded to 8 bytes: header of eight u64 (magic, documents, tokens, levels, then zeros);
doc ids i64, their validity u8; document starts u64 (one more than documents); for each level its number of chunks u64,
the chunks u8, the bitmap, the directory u32. A file holds at most about ``FILE_TOKENS`` tokens, or one document.

Defined cases: null text is empty; an empty text is the end id alone; a text of any length is encoded whole and lies in one
file; rows with a null id come first; equal ids, which may be dealt over several tasks, follow each other by the hash of their
texts; an empty table writes no file and reads back as no rows; other columns, whatever their names, are not read.
"""

from __future__ import annotations

import json
import os
import posixpath
import re
import sys
import uuid
import zlib
from array import array
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.llm.common import Saved, bounded_batches, new_path, read_bytes

MAGIC = int.from_bytes(b"tgDAC\x00\x00\x01", "little")
RANK_BITS = 512
FILE_TOKENS = 1 << 22
#: Files that a task reads back, and writing tasks whose files are numbered together.
FILES_A_TASK, PARTS = 8, 1024
END_ID = 0
#: Bytes of words and ids, about, that an encoder remembers in each of its two generations, and what an entry costs besides.
CACHE_BYTES, ENTRY_BYTES = 64 << 20, 130


class Encoder:
    """Whole-text ids of a tokenizer, equal to ``tokenizer.encode(text, add_special_tokens=False).ids``.

    A byte-level BPE with the usual pattern never joins across a space or line break that stands alone between two other
    characters, nor between a letter or digit and a mark that ends a word; so with such a tokenizer a text without runs of
    white space is encoded word by word, and the ids of recent words are remembered as bytes. Any other text goes to the
    tokenizer whole, and so does every text where the file names another normalizer, pre-tokenizer or model.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a worker has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.by_words = splits_at_spaces(json.loads(self.tokenizer.to_str()))
        self.merge = self.tokenizer.model.tokenize
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.size = 0

    def of(self, text: str) -> bytes:
        return _bytes(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def learn(self, words: list[str]) -> dict[str, bytes]:
        """The ids of a space and each word, or of w[1:] alone where w starts with the sign for no space."""
        found, odd = {}, []
        for w in words:
            known = self.old.get(w)
            if known is not None:
                found[w] = known
                continue
            space, body = ("", w[1:]) if w[0] == _NO_SPACE else (_SPACE_BYTE, w)
            if body.isascii() and body.isalpha():  # the pattern leaves plain letters whole, so the model alone will do
                found[w] = _bytes([t.id for t in self.merge(space + body)])
            elif _LETTERS.fullmatch(body):
                found[w] = _bytes([t.id for t in self.merge(space + body.encode().decode("latin-1").translate(_BYTES))])
            else:
                odd.append((w, body if w[0] == _NO_SPACE else " " + w))
        if odd:
            got = self.tokenizer.encode_batch_fast([text for _, text in odd], add_special_tokens=False)
            found |= {w: _bytes(x.ids) for (w, _), x in zip(odd, got, strict=True)}
        short = {w: x for w, x in found.items() if len(w) < 64}
        self.size += sum(map(len, short)) + sum(map(len, short.values())) + ENTRY_BYTES * len(short)
        if self.size > CACHE_BYTES:
            self.old, self.new, self.size = self.new, {}, 0
        self.new.update(short)
        return found

    def text(self, text: str) -> bytes:
        if not text:
            return b""
        if not self.by_words or "<|" in text or any(c in text for c in (_ASCII_SPACES if text.isascii() else _SPACES)):
            return self.of(text)
        marked = _MARK.sub(rf" {_NO_SPACE}\1", text).replace("\n", f" {_NO_SPACE}\n {_NO_SPACE}")
        words = (_NO_SPACE + marked).split(" ")
        if "" in words or _NO_SPACE in words:  # white space side by side, or at an end
            return self.of(text)
        got = list(map(self.new.get, words))
        if None in got:
            found = self.learn(list({w for x, w in zip(got, words, strict=True) if x is None}))
            got = [found[w] if x is None else x for x, w in zip(got, words, strict=True)]
        return b"".join(got)


def _bytes(ids: list[int]) -> bytes:
    out = array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


def _byte_letters() -> dict[int, str]:
    """The characters that stand for bytes in a byte-level vocabulary: printable ones for themselves, others from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    return dict(zip([b for b in range(256) if b not in plain], map(chr, range(0x100, 0x200)), strict=False))


_BYTES = _byte_letters()
_SPACE_BYTE = _BYTES[0x20]


def splits_at_spaces(file: dict) -> bool:
    """Whether a tokenizer file describes the byte-level BPE that words may be cut out for."""
    pre, model = file.get("pre_tokenizer") or {}, file.get("model") or {}
    plain = pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
    bpe = model.get("type") == "BPE" and not model.get("dropout") and not model.get("continuing_subword_prefix") and not model.get("end_of_word_suffix")
    return bool(plain and bpe and not file.get("normalizer") and all(t["content"].startswith("<|") for t in file.get("added_tokens") or []))


#: Before a word that no space precedes; texts with this character itself are not cut.
_NO_SPACE = "\r"
#: A mark that ends a word, after a plain letter or digit; marks are searched for first, which is quicker.
_MARK = re.compile(r"([.,!?;:])(?=[ \n]|\Z)(?<=[0-9A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u024F].)")
#: A word of plain letters.
_LETTERS = re.compile(r"[A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u024F]+")
#: White space other than spaces and line feeds.
_SPACES = [c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n"]
_ASCII_SPACES = [c for c in _SPACES if c.isascii()]


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    """The one encoder of this process; reading files back lets it go."""
    return Encoder(path)


def _pad(data: bytes) -> bytes:
    return data + bytes(-len(data) % 8)


def dump(doc_ids: list[int | None], ids: list[np.ndarray]) -> bytes:
    """A file's bytes for documents in order."""
    starts = np.concatenate([[0], np.cumsum([len(x) for x in ids], dtype=np.uint64)]).astype("<u8")
    rest = np.concatenate([np.zeros(0, "<u4"), *ids]).astype("<u4")
    levels = []
    while len(rest) or not levels:
        goes_on = rest > 255
        bits = np.packbits(goes_on, bitorder="little")
        whole = np.zeros(-(-len(bits) // (RANK_BITS // 8)) * (RANK_BITS // 8), np.uint8)
        whole[: len(bits)] = bits
        ones = np.bitwise_count(whole).reshape(-1, RANK_BITS // 8).sum(axis=1, dtype=np.uint64)
        ranks = np.concatenate([[0], np.cumsum(ones)]).astype("<u4")
        levels += [len(rest).to_bytes(8, "little"), _pad((rest & 255).astype(np.uint8).tobytes()), _pad(whole.tobytes()), _pad(ranks.tobytes())]
        rest = rest[goes_on] >> np.uint32(8)
    header = np.array([MAGIC, len(doc_ids), starts[-1], len(levels) // 4, 0, 0, 0, 0], "<u8").tobytes()
    keys = np.array([x or 0 for x in doc_ids], "<i8").tobytes()
    valid = np.array([x is not None for x in doc_ids], np.uint8).tobytes()
    return b"".join([header, keys, _pad(valid), starts.tobytes(), *levels])


class Reader:
    """Random access to a file's documents and tokens; ``data`` may be any buffer, such as a memory map."""

    def __init__(self, data):
        head = np.frombuffer(data, "<u8", 8)
        if head[0] != MAGIC:
            raise ValueError("not a file of directly addressable codes")
        n, at = int(head[1]), 64
        self.n_tokens, self.keys = int(head[2]), np.frombuffer(data, "<i8", n, at)
        at += 8 * n
        self.valid = np.frombuffer(data, np.uint8, n, at)
        at += n + -n % 8
        self.starts = np.frombuffer(data, "<u8", n + 1, at)
        at += 8 * (n + 1)
        self.levels = []
        for _ in range(int(head[3])):
            n = int(np.frombuffer(data, "<u8", 1, at)[0])
            chunks, at = np.frombuffer(data, np.uint8, n, at + 8), at + 8 + n + -n % 8
            words = -(-n // RANK_BITS)
            bitmap, at = np.frombuffer(data, np.uint8, words * RANK_BITS // 8, at), at + words * RANK_BITS // 8
            ranks, size = np.frombuffer(data, "<u4", words + 1, at), 4 * (words + 1)
            at += size + -size % 8
            self.levels.append((chunks, bitmap, ranks))

    def rank(self, level: int, i: int) -> int:
        """Ones of a level's bitmap before position i."""
        _, bitmap, ranks = self.levels[level]
        block, part = divmod(i, RANK_BITS)
        whole, bits = divmod(part, 8)
        at = block * RANK_BITS // 8
        n = int(ranks[block]) + int(np.bitwise_count(bitmap[at : at + whole]).sum())
        return n + (int(bitmap[at + whole]) & ((1 << bits) - 1)).bit_count() if bits else n

    def token(self, i: int) -> int:
        out, level = 0, 0
        while True:
            chunks, bitmap, _ = self.levels[level]
            out |= int(chunks[i]) << (8 * level)
            if not (int(bitmap[i >> 3]) >> (i & 7)) & 1:
                return out
            i, level = self.rank(level, i), level + 1

    def slice(self, a: int, b: int, level: int = 0) -> np.ndarray:
        """Tokens a to b."""
        if a >= b:
            return np.zeros(0, "<u4")
        chunks, bitmap, _ = self.levels[level]
        out = chunks[a:b].astype("<u4")
        goes_on = np.unpackbits(bitmap[a >> 3 : (b + 7) >> 3], bitorder="little")[a & 7 : (a & 7) + b - a].astype(bool)
        if goes_on.any():
            start = self.rank(level, a)
            out[goes_on] |= self.slice(start, start + int(goes_on.sum()), level + 1) << np.uint32(8)
        return out

    def document(self, k: int) -> np.ndarray:
        return self.slice(int(self.starts[k]), int(self.starts[k + 1]))


def _put(uri: str, data: bytes) -> None:
    """Write whole or not at all: another attempt at the same task may be at it too."""
    store, path = pafs.FileSystem.from_uri(uri)
    store.create_dir(posixpath.dirname(path), recursive=True)
    own = f"{path}.{uuid.uuid4().hex}"
    with store.open_output_stream(own) as out:
        out.write(data)
    store.move(own, path)


def get(uri: str) -> bytes:
    store, path = pafs.FileSystem.from_uri(uri)
    with store.open_input_file(path) as f:
        return f.read()


def _write(batches, base: str, tokenizer: str, end_id: int, file_tokens: int):
    enc, part, seq, keys, ids, n = encoder(tokenizer), TaskContext.get().partitionId(), 0, [], [], 0
    end = np.array([end_id], "<u4").tobytes()

    def flush():
        uri = f"{base}/part-{part:06d}-{seq:06d}.dac"
        _put(uri, dump(keys, ids))
        return pa.RecordBatch.from_pydict({"part": [part], "seq": [seq], "uri": [uri], "n_docs": [len(keys)], "n_tokens": [n]}, schema=pa.schema([("part", pa.int64()), ("seq", pa.int64()), ("uri", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())]))

    for b in batches:
        for key, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
            got = np.frombuffer(enc.text(text.as_py() or "") + end, "<u4")
            if keys and n + len(got) > file_tokens:
                yield flush()
                keys, ids, n, seq = [], [], 0, seq + 1
            keys.append(key)
            ids.append(got)
            n += len(got)
    if keys:
        yield flush()


def write(docs: DataFrame, tokenizer: str, base: str | None = None, end_id: int = END_ID, file_tokens: int = FILE_TOKENS) -> DataFrame:
    """Write ``docs(doc_id, text)`` in ascending id order and return the files: ``(uri, n_docs, n_tokens, start)``.

    One range shuffle by id; each task writes its files in order, and a file's ``start`` is the number of tokens before
    it. A task that runs again writes the same bytes to the same names.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    base = base or new_path(spark, "tokens")
    order = F.col("doc_id").asc_nulls_first(), F.xxhash64("text")
    ordered = docs.select(F.col("doc_id").cast("long"), "text").repartitionByRange(*order).sortWithinPartitions(*order, "text")
    rows = ordered.mapInArrow(partial(_write, base=base, tokenizer=tokenizer, end_id=end_id, file_tokens=file_tokens), "part long, seq long, uri string, n_docs long, n_tokens long")
    n = 1 + min(read_bytes(docs) >> 40, 1 << 10)  # a row for each file is little, and a task for each would make a table of crumbs
    files = Saved(rows.repartition(n), "files", few_files=False).df
    block = F.floor(F.col("part") / PARTS).alias("block")
    in_order = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    blocks = files.groupBy(block).agg(F.sum("n_tokens").alias("n")).select("block", F.coalesce(F.sum("n").over(in_order), zero).alias("base"))
    before = Window.partitionBy("block").orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    files = files.withColumn("block", block).join(blocks, "block")
    return files.select("uri", "n_docs", "n_tokens", (F.col("base") + F.coalesce(F.sum("n_tokens").over(before), zero)).alias("start"))


def _read(batches):
    encoder.cache_clear()
    for b in batches:
        for uri, start in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            f = Reader(get(uri))
            crc = [zlib.crc32(np.ascontiguousarray(f.document(k), "<u4").tobytes()) for k in range(len(f.keys))]
            keys = pa.array(f.keys, mask=f.valid == 0)
            first = f.starts.astype(np.int64)
            yield pa.RecordBatch.from_arrays([keys, pa.array(first[:-1] + start), pa.array(np.diff(first)), pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])


def read_back(files: DataFrame) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every document, from the files."""
    n = max(1, -(-files.count() // FILES_A_TASK))
    return files.select("uri", "start").repartition(n).mapInArrow(_read, "doc_id long, start long, n_tokens long, ids_crc32 long")
