"""Token counts with a whole-token shortcut.

The vocabulary's own merges never join a character other than the space mark
with a space mark after it (checked when the file is loaded), and it writes a
space mark before each text.  So a text's tokens are those of its pre-tokens,
each a run of spaces and the characters up to the next space.  Vocabulary
strings of that form that the library encodes alone as one token are proved
once, when the file is loaded; such pre-tokens count one.  Only the rest is
merged by the library, once per distinct pre-token of a task's table.

Edge cases: null and empty texts have no tokens; U+2581 in a text counts as a
space, as in the library; rows of equal text count alike.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, functions as F

from recordflow.llm.base import TABLE_SIZE, pick

MARK = "▁"
LIMIT = 4096
#: Pre-tokens of more characters are merged anew each time.
TABLED = 64
_PRE_TOKEN = re.compile(r" +[^ ]*")


def split_is_exact(pieces: list[str]) -> bool:
    """True if no piece holds a space mark after another character, so merges never cross into the next pre-token."""
    return not any(re.search(f"[^{MARK}]{MARK}", p) for p in pieces)


@cache
def load(path: str) -> tuple[sentencepiece.SentencePieceProcessor, frozenset[str]]:
    """The library's processor, and the pre-tokens (without their first space) that encode alone as one token."""
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    size = library.get_piece_size()
    plain = [
        i for i in range(size)
        if not (library.is_byte(i) or library.is_control(i) or library.is_unknown(i) or library.is_unused(i))
    ]
    pieces = {library.id_to_piece(i): i for i in plain}
    if not split_is_exact(list(pieces)) or library.encode("a") == library.encode(" a"):
        raise ValueError(f"{path}: merges can cross pre-tokens, or texts get no space mark of their own")
    alone = [p for p in pieces if p.startswith(MARK)]
    coded = library.encode([p[1:].replace(MARK, " ") for p in alone], num_threads=1)
    return library, frozenset(p[1:].replace(MARK, " ") for p, ids in zip(alone, coded) if ids == [pieces[p]])


class Counts(dict):
    """Tokens of a pre-token, written without its first space."""

    def __init__(self, path: str) -> None:
        self.library, whole = load(path)
        super().__init__(dict.fromkeys(whole, 1))
        # a single space by itself; the library reads the empty text that would stand for it as no token at all
        self[""] = len(self.library.encode("a ", num_threads=1)) - len(self.library.encode("a", num_threads=1))
        self.first = len(self)

    def __missing__(self, rest: str) -> int:
        found = len(self.library.encode(rest, num_threads=1))
        if len(rest) <= TABLED and len(self) < self.first + TABLE_SIZE:
            self[rest] = found
        return found

    def of(self, text: str | None) -> int:
        if not text:
            return 0
        if MARK in text:
            text = text.replace(MARK, " ")
        if "  " in text or text[0] == " " or text[-1] == " ":
            return sum(self[p[1:]] for p in _PRE_TOKEN.findall(" " + text))
        return sum(map(self.__getitem__, text.split(" ")))


def count_tokens(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row, as the library encodes the whole text."""

    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        counts = Counts(path)
        for column in columns:
            yield pa.array([counts.of(t) for t in column.to_pylist()], pa.int64())
            if len(counts) >= counts.first + TABLE_SIZE:
                counts = Counts(path)

    n_bytes = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    n_tokens = F.arrow_udf(run, "long").asNondeterministic()(F.col("text"))
    counted = pick(docs, "doc_id", "text").select("doc_id", n_bytes.alias("n_bytes"), n_tokens.alias("n_tokens"))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
