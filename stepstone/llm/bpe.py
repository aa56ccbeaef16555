"""Byte-level BPE by a table of distinct words, and decoding by a join of ids with pieces.

Spark splits the texts into words.  Each distinct word of the table is encoded once, where the shuffle by word has brought
all its blocks together, and the ids go back to the word's places by block and number.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
import tiktoken
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from stepstone.llm import wordblocks
from stepstone.llm.registry import documents, query
from stepstone.llm.texts import spread_ranges
from stepstone.llm.vocabulary import byte_pieces, special_tokens

#: White space as the tokenizers library sees it, and the contractions that are words of their own.
SPACE = r"\t-\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"
#: Words whose ids a task sends back at once.
ROWS_AT_ONCE = 1 << 20
#: Ids decoded at once.
IDS_AT_ONCE = 1 << 18


def _ranges(letters: str) -> str:
    """A string of single code points as ranges of a character class."""
    points = sorted(map(ord, letters))
    begins = [p for k, p in enumerate(points) if not k or points[k - 1] != p - 1]
    ends = [p for k, p in enumerate(points) if k + 1 == len(points) or points[k + 1] != p + 1]
    return "".join(rf"\x{{{a:x}}}-\x{{{b:x}}}" for a, b in zip(begins, ends, strict=True))


@lru_cache(maxsize=4)
def _library_class(path: str, anchor: str) -> str:
    """Code points that the library's splitter joins to a run of ``anchor``, among those that Unicode now has as such."""
    points = regex.findall(r"[\p{L}\p{N}]", "".join(chr(p) for p in range(0x80, 0x110000) if not 0xD800 <= p < 0xE000))
    splitter, found = Tokenizer.from_file(path).pre_tokenizer, []
    for at in range(0, len(points), 1 << 16):
        some = points[at : at + (1 << 16)]
        for _, (a, b) in splitter.pre_tokenize_str("".join(anchor + c for c in some)):
            a += a % 2  # the first anchor of the run
            found += [some[k] for k in range(a // 2, b // 2)]
    return "".join(found)


def split_pattern(spark: SparkSession, path: str) -> str:
    """Java pattern of the words that the library splits a text into; a special token is a word.

    The library knows newer letters and digits than the JVM; what the JVM's own classes leave out is added by code point.
    """

    def kind(own: str, anchor: str) -> str:
        known = _library_class(path, anchor)
        rest = spark.range(1).select(F.regexp_replace(F.lit(known), own, "").alias("r")).first()["r"]
        if not rest:
            return own
        return rf"[{own}[[^\x{{0}}-\x{{{ord(min(rest)) - 1:x}}}]&&[{_ranges(rest)}]]]"

    letter, digit = kind(r"\p{L}", "a"), kind(r"\p{N}", "1")
    special = "|".join(r"\Q" + s + r"\E" for s in sorted(special_tokens(path), key=len, reverse=True)) or "(?!)"
    other = rf"(?:(?!{special})(?!{letter}|{digit})[^{SPACE}])"
    return f"{special}|{CONTRACTIONS}| ?{letter}++| ?{digit}++| ?{other}++|[{SPACE}]+(?!(?!{special})[^{SPACE}])|[{SPACE}]+"


def split_words(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(F.coalesce(text.cast("string"), F.lit("")), F.lit(pattern), F.lit(0))


class Encoder:
    """Ids of words; the merge order of the vocabulary is that of its ids."""

    def __init__(self, path: str):
        self.special = special_tokens(path)
        self.core = tiktoken.Encoding("words", pat_str=r"(?s:.+)", mergeable_ranks=byte_pieces(path), special_tokens={})

    def encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words on end, and how many each word has."""
        special, encode = self.special, self.core.encode_ordinary
        lists = [[special[w]] if w in special else encode(w) for w in words]
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        return np.fromiter((k for ids in lists for k in ids), np.int64, int(sizes.sum())), sizes


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """Built once in each Python worker."""
    return Encoder(path)


def _encoded_blocks(words: DataFrame, path: str) -> DataFrame:
    """(block, no, size, ids, mark), packed: each distinct word is encoded once, all rows of it lie side by side."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine, last = encoder(path), (None, None)
        held: list[tuple[np.ndarray, ...]] = []

        def flush() -> Iterator[pa.RecordBatch]:
            block, no, sizes, hashes, ids = (np.concatenate([h[k] for h in held]) for k in range(5))
            order = np.argsort(block, kind="stable")
            begins = np.cumsum(sizes) - sizes
            edges = np.flatnonzero(np.diff(block[order], prepend=-1, append=-1))
            rows = [order[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([
                pa.array([int(block[r[0]]) for r in rows]), pa.array([wordblocks.pack(no[r]) for r in rows]),
                pa.array([wordblocks.pack(sizes[r]) for r in rows]),
                pa.array([wordblocks.pack(ids[spread_ranges(begins[r], sizes[r])]) for r in rows]),
                pa.array([wordblocks.mark(hashes[r], no[r]) for r in rows], pa.int64()),
            ], names=["block", "no", "size", "ids", "mark"])
            held.clear()

        for batch in batches:
            local = batch.column(0).dictionary_encode()
            names, which = local.dictionary.to_pylist(), local.indices.to_numpy(zero_copy_only=False)
            if names and names[0] == last[0]:  # goes on from the batch before
                ids, sizes = machine.encode(names[1:])
                ids, sizes = np.concatenate([last[1], ids]), np.concatenate([[len(last[1])], sizes]).astype(np.int64)
            else:
                ids, sizes = machine.encode(names)
            if names:
                last = (names[-1], ids[len(ids) - sizes[-1] :])
            begins = np.cumsum(sizes) - sizes
            held.append((
                batch.column(1).to_numpy(zero_copy_only=False), batch.column(2).to_numpy(zero_copy_only=False), sizes[which],
                batch.column(3).to_numpy(zero_copy_only=False), ids[spread_ranges(begins[which], sizes[which])],
            ))
            if sum(len(h[0]) for h in held) >= ROWS_AT_ONCE:
                yield from flush()
        if held:
            yield from flush()

    together = words.select("word", "block", "no").repartition("word").sortWithinPartitions("word").withColumn("hash", F.xxhash64("word"))
    return together.mapInArrow(run, "block bigint, no binary, size binary, ids binary, mark bigint")


def _ids_of_block(values: pa.Table):
    """Mark of a block's words and the reader of its numbered rows, from its packed words."""
    parts = [[wordblocks.unpack(x) for x in values.column(c).to_pylist()] for c in ("no", "size", "ids")]
    no, sizes, ids = (np.concatenate(p).astype(np.int64) if p else np.zeros(0, np.int64) for p in parts)
    begins = np.cumsum(sizes) - sizes
    size_of, begin_of = np.zeros(len(no), np.int64), np.zeros(len(no), np.int64)
    if len(no) and not (np.bincount(no, minlength=len(no)) == 1).all():
        raise RuntimeError("the words of a block are not whole; its rows were read in another order")
    size_of[no], begin_of[no] = sizes, begins
    ids = ids.astype(np.int32)

    def read(words: np.ndarray, codes: np.ndarray) -> list[pa.Array]:
        if len(codes) and codes.max() >= len(no):
            raise RuntimeError("a block has rows with words that it doesn't know")
        each = size_of[codes]
        flat = ids[spread_ranges(begin_of[codes], each)]
        before = np.concatenate([[0], np.cumsum(each)])
        ends = before[np.cumsum(words)]
        return [pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(flat))]

    return int(values.column("mark").to_numpy().sum(dtype=np.int64)), read


def encode(docs: DataFrame, path: str, keys: list[str] | None = None, text_col: str = "text") -> DataFrame:
    """(``keys``, ids array<int>) of every row, as the tokenizers library encodes whole texts without adding tokens.

    A null or empty text has no ids.  Texts may be of any length; only columns ``keys`` come along.
    """
    keys = keys or ["doc_id"]
    words = split_words(F.col(text_col), split_pattern(docs.sparkSession, path))
    table = _encoded_blocks(wordblocks.block_words(docs, keys, words, F.lit(True)), path)
    return wordblocks.join_back(table, wordblocks.numbered_rows(docs, keys, words), keys, _ids_of_block, "ids array<int>")


@lru_cache(maxsize=2)
def _pieces(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all pieces on end, with the start and size of each id's piece; the vocabulary bounds it."""
    table = {k: p for p, k in byte_pieces(path).items()} | {k: s.encode() for s, k in special_tokens(path).items()}
    sizes = np.array([len(table.get(k, b"")) for k in range(max(table) + 1)], np.int64)
    return np.frombuffer(b"".join(table[k] for k in sorted(table)), np.uint8), np.cumsum(sizes) - sizes, sizes


def texts_of(lists: pa.Array, path: str) -> Iterator[str]:
    """Text of each list of ids; null lists are empty."""
    data, begins, sizes = _pieces(path)
    counts = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    ends, ids, at = np.cumsum(counts), lists.flatten().to_numpy(zero_copy_only=False), 0
    while at < len(counts):
        begun = int(ends[at - 1]) if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, begun + IDS_AT_ONCE, "right")))
        some = ids[begun : ends[stop - 1]]
        flat = data[spread_ranges(begins[some], sizes[some])].tobytes()
        until = np.concatenate([[0], np.cumsum(sizes[some])])[np.concatenate([[begun], ends[at:stop]]) - begun].tolist()
        for a, b in zip(until[:-1], until[1:], strict=True):
            yield flat[a:b].decode("utf-8", "replace")
        at = stop


def decode(encoded: DataFrame, path: str, ids_col: str = "ids", name: str = "decoded", finish: Callable | None = None, schema: str | None = None) -> DataFrame:
    """Add the text of ``ids_col``; special tokens are kept, broken UTF-8 becomes U+FFFD, null ids give an empty text.

    The id-to-piece side of the join is the vocabulary, some 50,000 pieces whatever the input; it is an array that a task
    looks ids up in, many at once.  ``finish(batch, texts)`` may return other columns, of ``schema``, while texts are at hand.
    """
    at, names = encoded.columns.index(ids_col), [*encoded.columns, name]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch.column(at), path)
            if finish:
                yield finish(batch, texts)
            else:
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(list(texts), pa.string())], names=names)

    whole = ", ".join(f"`{n}` {t}" for n, t in [*encoded.dtypes, (name, "string")])
    return encoded.mapInArrow(run, schema if finish else whole)


@query("op7_word_table_bpe")
def word_table_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")

    def digest(batch: pa.RecordBatch, texts: Iterator[str]) -> pa.RecordBatch:
        lists = batch.column("ids")
        flat, sizes = lists.flatten().to_numpy(zero_copy_only=False).astype("<u4", copy=False), lists.value_lengths().to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes)
        return pa.RecordBatch.from_arrays([
            batch.column("doc_id"), pa.array(sizes.astype(np.int64)),
            pa.array([hashlib.sha256(flat[b - n : b].tobytes()).hexdigest() for b, n in zip(ends, sizes, strict=True)], pa.string()),
            pa.array([hashlib.sha256(t.encode()).hexdigest() for t in texts], pa.string()),
        ], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return decode(encode(documents(spark, sf_dir), path), path, finish=digest, schema=schema)
