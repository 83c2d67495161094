"""Token counts by the whole-token shortcut.

Most pre-tokens of a byte-level BPE text are themselves vocabulary entries, but that alone
does not prove that they encode as one token.  So it is proved offline, once per vocabulary:
every entry that is a valid string is encoded alone, and those that give exactly themselves
form the whole-token set (at most as large as the vocabulary, so it may be broadcast).  A
text is cut into pre-tokens; those in the set count one, and only the others go to the BPE
merges, each distinct one once per batch and remembered in a bounded cache.

The pre-token pattern is spelled for Python's ``re`` with the code points of the letter and
number classes.  Code points whose class differs between Unicode 3.2 and the present tables
may be classed otherwise by the library; texts with any of them are counted by the library.

Defined results: a null text counts as empty (0 bytes, 0 tokens); special strings inside a
text are special tokens (the library's default); nothing is added, cut or padded; rows are
kept as they are, repeated ids too; other columns are ignored.
"""

from __future__ import annotations

import functools
import json
import re
import sys
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trellis.llm.common import register, table

LIMIT = 1024
CACHE_ENTRIES = 400_000
# Unicode White_Space, as in the library's \s
WHITE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"


def _ranges(points: list[int]) -> str:
    """A character class body for sorted code points."""
    out, start, last = [], None, None
    for p in [*points, None]:
        if start is not None and p != last + 1:
            out.append(f"\\U{start:08x}-\\U{last:08x}")
            start = None
        start, last = (p, p) if start is None else (start, p)
    return "".join(out)


@functools.cache
def patterns() -> tuple[re.Pattern, re.Pattern]:
    """(pre-tokens, code points to leave to the library)."""
    letters, numbers, odd = [], [], []
    for p in range(sys.maxunicode + 1):
        now, then = unicodedata.category(chr(p)), unicodedata.ucd_3_2_0.category(chr(p))
        if now[0] == "L":
            letters.append(p)
        elif now[0] == "N":
            numbers.append(p)
        if now[0] != then[0] and {now[0], then[0]} & set("LNZ"):
            odd.append(p)
    lt, nm = _ranges(letters), _ranges(numbers)
    return (re.compile(f"'(?:[stmd]|re|ve|ll)| ?[{lt}]+| ?[{nm}]+| ?[^{WHITE}{lt}{nm}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+"),
            re.compile(f"[{_ranges(odd)}]"))


@functools.cache
def tokenizer(path: str):
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def whole_tokens(path: str) -> list[str]:
    """The proof: vocabulary strings that encode alone as their own single token."""
    tok = tokenizer(path)
    vocab = tok.get_vocab(with_added_tokens=False)
    ids = list(vocab.values())
    texts = tok.decode_batch([[i] for i in ids], skip_special_tokens=False)
    special = set(special_strings(path))
    return [t for t, i, e in zip(texts, ids, tok.encode_batch(texts, add_special_tokens=False))
            if e.ids == [i] and t not in special]


def special_strings(path: str) -> list[str]:
    with open(path, encoding="utf-8") as f:
        return [t["content"] for t in json.load(f)["added_tokens"]]


class Lengths(dict):
    """Tokens of a pre-token; a missing one is merged by the library and remembered."""

    def __init__(self, whole: list[str], path: str):
        super().__init__(dict.fromkeys(whole, 1))
        self.whole, self.path = whole, path

    def learn(self, pieces: set[str]) -> None:
        """Merge the pieces that are not whole tokens."""
        rest = [p for p in pieces if p not in self]
        if len(self) + len(rest) > len(self.whole) + CACHE_ENTRIES:
            self.clear()
            self.update(dict.fromkeys(self.whole, 1))
            rest = [p for p in pieces if p not in self]
        if rest:
            self.update(zip(rest, map(len, tokenizer(self.path).encode_batch_fast(rest, add_special_tokens=False))))


def count_tokens(texts: list[str], lengths: Lengths, specials: list[str]) -> list[int]:
    """Tokens of each text, as the library counts them."""
    pre, odd = patterns()
    split = re.compile("|".join(map(re.escape, sorted(specials, key=len, reverse=True)))) if specials else None
    out = []
    for lo in range(0, len(texts), 256):
        cut: list[list[str] | None] = []
        extra = []
        for text in texts[lo:lo + 256]:
            if not text.isascii() and odd.search(text):
                cut.append(None)
                extra.append(len(tokenizer(lengths.path).encode(text, add_special_tokens=False)))
                continue
            parts = split.split(text) if split is not None and any(s in text for s in specials) else [text]
            extra.append(len(parts) - 1)
            cut.append([p for part in parts for p in pre.findall(part)] if len(parts) > 1 else pre.findall(text))
        lengths.learn(set().union(*(c for c in cut if c)))
        out += [n + (sum(map(lengths.__getitem__, c)) if c else 0) for c, n in zip(cut, extra)]
    return out


def add_token_counts(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``docs`` (any columns) narrowed to doc_id with n_bytes and n_tokens."""
    spark = docs.sparkSession
    whole = spark.sparkContext.broadcast(whole_tokens(path))  # at most the vocabulary
    specials = special_strings(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = Lengths(whole.value, path)
        for b in batches:
            texts = b.column("text").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("n_bytes"), pa.array(count_tokens(texts, lengths, specials), pa.int64())],
                names=["doc_id", "n_bytes", "n_tokens"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    whole_text = F.coalesce(F.col(text), F.lit(""))
    return (docs.select("doc_id", F.octet_length(whole_text).cast("long").alias("n_bytes"), whole_text.alias("text"))
            .mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long"))


@register("op2_whole_token_counts")
def op2_whole_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document under the 50k byte-level BPE vocabulary."""
    import public_tokenizers

    counts = add_token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return counts.withColumn("over_limit", F.col("n_tokens") > LIMIT)
