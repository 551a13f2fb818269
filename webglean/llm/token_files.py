"""Token ids as flat files of unsigned integers, with 64-bit document offsets beside them.

``write_tokens`` deals the documents out in ranges of ``doc_id`` and writes one pair of files a
range. ``<name>.ids`` holds nothing but the ids, little-endian, 16 bits where the vocabulary fits and
32 bits elsewhere. ``<name>.idx`` holds the number of documents n, then n document ids, n null marks
and n + 1 offsets counted in ids from the start of that file, all 64 bits. A prefix sum over the
ranges gives each file its base. ``read_tokens`` maps the files and returns one row per document.

A null text is empty. Null document ids come first, repeated ones stand side by side, ordered by
a hash of their text; both keep their rows. No documents give no files. Only the two named columns are read.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
from collections.abc import Callable, Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F
from tokenizers import Tokenizer, pre_tokenizers

# Classes that a pattern may name, as the regex library spells them.
CLASSES = {r"\p{L}": r"\p{L}", r"\p{N}": r"\p{N}", r"\s": r"\p{White_Space}", r"\S": r"\P{White_Space}"}
# Texts below this sign are cut by the standard library, with the members of the classes listed.
PLAIN = 0x3000
REMEMBERED = 600_000
# Documents in a batch that is tokenised together.
BATCH = 256


class TokenFiles(NamedTuple):
    """``files``: name, documents, ids and base of every range, in order; one row a range."""

    folder: str
    width: int
    files: list[tuple[str, int, int, int]]


def _members(name: str) -> str:
    """The signs below ``PLAIN`` of a class, as ranges for a set of the standard library."""
    found = regex.findall(f"{CLASSES[name]}+", "".join(map(chr, range(PLAIN))))
    return "".join(f"\\u{ord(run[0]):04x}-\\u{ord(run[-1]):04x}" for run in found)


def _ascii_cut(pattern: str) -> Callable[[str], list[str]] | None:
    """The cut of texts below ``PLAIN``, which the standard library does in half the time; None if the
    pattern names other classes."""
    members = {name: _members(name) for name in CLASSES}

    def plain(found: re.Match) -> str:
        part = found[0]
        if part not in members:
            for name, signs in members.items():
                part = part.replace(name, signs)
            return part
        return f"[{members[part]}]"

    spelled = re.sub(r"\[[^\]]*\]|\\[pP]\{\w+\}|\\[a-zA-Z]", plain, pattern)
    known = re.fullmatch(r"(?:[^\\]|\\[trxnu])*", spelled) and "(?i" not in spelled
    return re.compile(spelled).findall if known else None


class _Vocabulary:
    """Ids of pieces of text from the tokenizers library; every different piece is asked once."""

    def __init__(self, path: str, pattern: str):
        # Spark runs a worker for every core, so threads inside one would only wait for each other.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.model = Tokenizer.from_file(path)
        self.model.encode_special_tokens = True  # their strings in a text are ordinary text
        # Pieces come cut; only their bytes are left to be spelled.
        self.model.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.width = 2 if self.model.get_vocab_size() <= 1 << 16 else 4
        self.known: dict[str, bytes] = {}
        spaces = pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")
        self.cut = regex.compile(spaces).findall
        self.cut_ascii = _ascii_cut(pattern) or self.cut
        self.is_plain = re.compile(f"[\0-{chr(PLAIN - 1)}]*").fullmatch

    def encode(self, texts: list[str]) -> list[bytes]:
        cut = [self.cut_ascii(text) if text.isascii() or self.is_plain(text) else self.cut(text) for text in texts]
        known = self.known
        if len(known) > REMEMBERED:
            known.clear()
        fresh = list(set().union(*cut).difference(known))
        if fresh:
            found = self.model.encode(fresh, is_pretokenized=True, add_special_tokens=False)
            ids = np.array(found.ids, f"<u{self.width}").tobytes()
            ends = np.bincount(np.array(found.word_ids), minlength=len(fresh)).cumsum() * self.width
            start = 0
            for piece, end in zip(fresh, ends.tolist()):
                known[piece] = ids[start:end]
                start = end
        return [b"".join(map(known.__getitem__, pieces)) for pieces in cut]


@cache
def _vocabulary(path: str, pattern: str) -> _Vocabulary:
    return _Vocabulary(path, pattern)


def _opened(folder: str) -> tuple[pa.fs.FileSystem, str]:
    return pa.fs.FileSystem.from_uri(folder)


def write_tokens(
    df: DataFrame, folder: str, path: str, pattern: str, end_id: int = 0, key: str = "doc_id",
    text: str = "text",
) -> TokenFiles:
    """Tokenise, append ``end_id`` to each document, and write the files in ascending ``key`` order.

    ``path`` is a vocabulary of the tokenizers library and ``pattern`` the cut of its byte-level
    pre-tokenizer. ``folder`` must be seen by all executors. A task that is run again writes files
    of another name, and only those of the run that counted are listed.
    """

    def written(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = _vocabulary(path, pattern)
        part, name = TaskContext.get().partitionId(), uuid.uuid4().hex
        fs, at = _opened(folder)
        out, keys, nulls, lengths = None, [], [], []
        end = int(end_id).to_bytes(words.width, "little")
        for batch in batches:
            if out is None and len(batch):
                fs.create_dir(at, recursive=True)
                out = fs.open_output_stream(f"{at}/{name}.ids")
            for i in range(0, len(batch), BATCH):
                rows = batch.iloc[i : i + BATCH]
                ids = words.encode([x or "" for x in rows["text"]])
                out.write(b"".join(x + end for x in ids))
                lengths += [len(x) // words.width + 1 for x in ids]
                nulls.append(rows["key"].isna().to_numpy(np.int64))
                keys.append(rows["key"].fillna(0).to_numpy(np.int64))
        if out is None:
            return
        out.close()
        offsets = np.concatenate([[0], np.cumsum(lengths)])
        with fs.open_output_stream(f"{at}/{name}.idx") as index:
            index.write(struct.pack("<Q", len(lengths)))
            index.write(np.concatenate(keys).astype("<i8").tobytes())
            index.write(np.concatenate(nulls).astype("<i8").tobytes())
            index.write(offsets.astype("<u8").tobytes())
        yield pd.DataFrame({
            "part": [part], "name": [name], "docs": [len(lengths)], "ids": [int(offsets[-1])],
            "width": [words.width],
        })

    ordered = (
        df.select(
            F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"),
            F.xxhash64(F.col(text).cast("string")).alias("turn"),
        )
        .repartitionByRange("key", "turn")
        .sortWithinPartitions("key", "turn", "text")
    )
    shape = "part int, name string, docs long, ids long, width int"
    # One row a range of documents.
    rows = sorted(ordered.mapInPandas(written, shape).collect())
    files, base = [], 0
    for row in rows:
        files.append((row.name, row.docs, row.ids, base))
        base += row.ids
    return TokenFiles(folder, rows[0].width if rows else 2, files)


def read_tokens(spark: SparkSession, tokens: TokenFiles) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` as the files have them; ``ids`` little-endian, 32 bits."""
    folder, width = tokens.folder, tokens.width

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                yield from _read_file(folder, width, row.name, row.base)

    listed = [(name, base) for name, _, _, base in tokens.files]
    files = spark.createDataFrame(listed, "name string, base long")
    files = files.repartition(max(1, len(listed)), "base")
    return files.mapInPandas(read, "doc_id long, start long, n_tokens long, ids binary")


def _read_file(folder: str, width: int, name: str, base: int) -> Iterator[pd.DataFrame]:
    fs, at = _opened(folder)
    local = isinstance(fs, pa.fs.LocalFileSystem)
    mapped = pa.memory_map if local else fs.open_input_file
    with mapped(f"{at}/{name}.idx") as index, mapped(f"{at}/{name}.ids") as data:
        n = int.from_bytes(index.read_at(8, 0), "little")
        keys = np.frombuffer(index.read_at(8 * n, 8), "<i8")
        nulls = np.frombuffer(index.read_at(8 * n, 8 + 8 * n), "<i8")
        offsets = np.frombuffer(index.read_at(8 * (n + 1), 8 + 16 * n), "<u8").astype(np.int64)
        for i in range(0, n, BATCH):
            stop = min(n, i + BATCH)
            start, size = int(offsets[i]), int(offsets[stop] - offsets[i])
            ids = np.frombuffer(data.read_at(size * width, start * width), f"<u{width}")
            ids = ids.astype("<u4").tobytes()
            yield pd.DataFrame({
                "doc_id": pd.arrays.IntegerArray(keys[i:stop].copy(), nulls[i:stop] != 0),
                "start": base + offsets[i:stop],
                "n_tokens": np.diff(offsets[i : stop + 1]),
                "ids": [
                    ids[4 * (int(offsets[k]) - start) : 4 * (int(offsets[k + 1]) - start)]
                    for k in range(i, stop)
                ],
            })
