"""Spelling variants through a dictionary of pairs of trie nodes.

Words are numbered in a trie, and their reversals in a second one: a node of the first
stands for a prefix, one of the second for a suffix. Word and position give two kinds of
integer pairs. Leaving a letter out joins (prefix before it, suffix behind it); cutting
between letters joins (prefix, suffix). Words of one left-out pair differ in that letter; a
word's cut pair that is another's left-out pair is the other without that letter. So words
one edit apart are exactly those that share a pair. Of a run of equal letters only the first
counts as left out towards cut pairs, so each neighbour is met once.

A pair is shared by one cut word and at most one word per letter of the alphabet, whatever
the number of words, and gives back per word a count and the best neighbour.

Tries are numbered on sorted words, each against the one before. Words that share their
first ``HEAD`` letters meet in one task; nodes up to that depth are numbered by their
letters, deeper ones by a counter. A task holds two words.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldrow.llm.words import blocks, texts_of, word_table
from goldrow.session import spread_scan, write_through

MIN_LENGTH = 6
MIN_COUNT = 5
#: A form is at least this many times as frequent.
RATIO = 5
#: Tokens whose checksum this divides lose a letter; 0 for none.
DAMAGE = 199
#: Letters of which a node's number is made, a byte each.
HEAD = 6
#: Bits of a task's counter in the number of a deeper node.
COUNTER_BITS = 40
#: Longest words, in bytes, whose checksums come from those of their parts.
SHORT = 64
#: Entries of the pair dictionary in a batch.
BATCH = 100_000

# Kinds of entries: a letter left out, the first of its run left out, a cut.
OUT, FIRST_OUT, CUT = 0, 1, 2

_LOWER = np.full(256, ord(" "), np.uint8)
for _first in (ord("a"), ord("A")):
    _LOWER[_first : _first + 26] = np.arange(ord("a"), ord("z") + 1)
#: Lead byte of the letters from U+00C0 to U+00FF; nothing else has it.
_LATIN = 0xC3


def _crc_table() -> np.ndarray:
    values = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        values = np.where(values & 1, np.uint32(0xEDB88320), np.uint32(0)) ^ (values >> 1)
    return values


_CRC = _crc_table()


def letters_only(texts: pa.Array) -> pa.Array:
    """The texts with A-Z made small and a space for every byte that is not in a run."""
    _, offsets, data = texts.buffers()
    if not data or not data.size:
        return texts
    raw = np.frombuffer(data, np.uint8)
    lead = raw == _LATIN
    held = lead.copy()
    held[1:] |= lead[:-1]
    out = np.where(held, raw, _LOWER[raw])
    return pa.Array.from_buffers(pa.large_string(), len(texts), [None, offsets, pa.py_buffer(out)])


def _checksums(prefixes: list[bytes], text_of: np.ndarray, codes: np.ndarray, words: list[bytes]) -> np.ndarray:
    """CRC-32 of prefix + word per token.

    CRC-32 is linear: that of two parts is the first part's, moved on by the length of the
    second, and the second part's. Prefixes are moved on once per length.
    """
    own = np.array([zlib.crc32(w) for w in words], np.uint32)
    size = np.array([len(w) for w in words], np.int64)
    moved = np.empty((SHORT + 1, len(prefixes)), np.uint32)
    moved[0] = [zlib.crc32(p) for p in prefixes]
    for at in range(1, SHORT + 1):
        moved[at] = _CRC[moved[at - 1] & 255] ^ (moved[at - 1] >> 8)
    out = moved[np.minimum(size, SHORT)[codes], text_of] ^ own[codes]
    for at in np.flatnonzero(size[codes] > SHORT):
        out[at] = zlib.crc32(words[codes[at]], int(moved[0, text_of[at]]))
    return out


def block_counts(ids: list[str], texts: pa.Array, min_length: int, damage: int) -> Counter:
    """Counts of the words of a block's texts, of ``min_length`` letters or more."""
    table = word_table(letters_only(texts))
    n_letters = pc.utf8_length(table.words).to_numpy()
    long = n_letters[table.codes] >= min_length
    codes = table.codes[long]
    if not len(codes):
        return Counter()
    text_of = np.repeat(np.arange(len(texts)), np.diff(table.starts))[long]
    # Only the words that are left.
    used, codes = np.unique(codes, return_inverse=True)
    words = table.words.take(pa.array(used)).cast(pa.large_binary()).to_pylist()
    n_letters = n_letters[used]
    counts = Counter()
    if damage:
        sums = _checksums([f"{i}:".encode() for i in ids], text_of, codes, words)
        hit = sums % damage == 0
        for code, value in zip(codes[hit].tolist(), sums[hit].tolist(), strict=True):
            word = words[code].decode()
            at = value % len(word)
            if len(word) > min_length:
                counts[word[:at] + word[at + 1 :]] += 1
        codes = codes[~hit]
    n = np.bincount(codes, minlength=len(words))
    for code in np.flatnonzero(n).tolist():
        counts[words[code].decode()] += int(n[code])
    return counts


def count_words(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    min_length: int = MIN_LENGTH,
    min_count: int = MIN_COUNT,
    damage: int = DAMAGE,
) -> DataFrame:
    """Rows (word, n) over all texts: runs of the letters A-Z, a-z and U+00C0 to U+00FF, A-Z
    made small, that have ``min_length`` letters and occur ``min_count`` times or more.

    A run loses a letter if ``damage`` divides h, the CRC-32 of ``key:run``: letter h modulo
    its length. A null text has no words, a null key is an empty one.
    """

    def task(batches) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text"):
            counts = block_counts(
                block.column("key").to_pylist(), texts_of(block), min_length, damage
            )
            yield pa.RecordBatch.from_arrays(
                [pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())],
                names=["word", "n"],
            )

    rows = spread_scan(
        df.select(
            F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")).alias("key"),
            F.col(f"`{text}`").alias("text"),
        )
    )
    counted = rows.mapInArrow(task, "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


class _Trie:
    """Numbers of the nodes on a word's path, for words that come sorted."""

    def __init__(self, task: int):
        self.base, self.count = task << COUNTER_BITS, 0
        self.word, self.path = "", [0]

    def add(self, word: str) -> list[int]:
        """Node of every prefix, from the empty one on. Nodes up to ``HEAD`` letters deep are
        positive and the same in every task; deeper ones are negative and of this task."""
        shared, before = 0, self.word
        for a, b in zip(word, before):
            if a != b:
                break
            shared += 1
        path = self.path[: shared + 1]
        for depth in range(shared, len(word)):
            if depth < HEAD:
                path.append(path[-1] << 8 | ord(word[depth]))
            else:
                self.count += 1
                path.append(-(self.base + self.count))
        self.word, self.path = word, path
        return path


def _sorted_by(df: DataFrame, word: str) -> DataFrame:
    # A number of tasks of its own: the rows are small, but each becomes many.
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(partitions, F.substring(word, 1, HEAD)).sortWithinPartitions(word)


def _prefix_nodes(batches) -> Iterator[pa.RecordBatch]:
    trie = _Trie(TaskContext.get().partitionId())
    for batch in batches:
        paths = [trie.add(w) for w in batch.column("word").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(paths, pa.list_(pa.int64()))],
            names=[*batch.schema.names, "prefixes"],
        )


def _entries(batches) -> Iterator[pa.RecordBatch]:
    """Pairs of all words, which come sorted by their reversals."""
    trie = _Trie(TaskContext.get().partitionId())
    held: list[list[np.ndarray]] = []
    size = 0

    def out() -> pa.RecordBatch:
        columns = [pa.array(np.concatenate(c)) for c in zip(*held, strict=True)]
        return pa.RecordBatch.from_arrays(columns, names=["prefix", "suffix", "id", "n", "kind"])

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("id", "n", "reversed")]
        paths = batch.column("prefixes")
        for row, (number, n, word) in enumerate(zip(*columns, strict=True)):
            prefixes = paths[row].values.to_numpy()
            suffixes = np.array(trie.add(word), np.int64)[::-1]
            letters = np.frombuffer(word[::-1].encode("utf-32-le"), np.uint32)
            kinds = np.full(2 * len(letters) + 1, CUT, np.int8)
            kinds[0] = FIRST_OUT
            kinds[1 : len(letters)] = np.where(letters[1:] != letters[:-1], FIRST_OUT, OUT)
            held.append(
                [
                    np.concatenate([prefixes[:-1], prefixes]),
                    np.concatenate([suffixes[1:], suffixes]),
                    np.full(len(kinds), number, np.int64),
                    np.full(len(kinds), n, np.int64),
                    kinds,
                ]
            )
            size += len(kinds)
            if size >= BATCH:
                yield out()
                held, size = [], 0
    if held:
        yield out()


def pair_dictionary(words: DataFrame) -> DataFrame:
    """Rows (prefix, suffix, id, n, kind) of stored rows (id, word, n), words unlike each
    other: the node pairs of every letter left out and of every cut."""
    forward = _sorted_by(words, "word").mapInArrow(
        _prefix_nodes, "id bigint, word string, n bigint, prefixes array<bigint>"
    )
    backward = forward.select("id", F.reverse("word").alias("reversed"), "n", "prefixes")
    return _sorted_by(write_through(backward, "prefix-nodes"), "reversed").mapInArrow(
        _entries, "prefix bigint, suffix bigint, id bigint, n bigint, kind tinyint"
    )


def neighbours(words: DataFrame) -> DataFrame:
    """Rows (id, n_near, best) of the words that have a word one edit away: how many, and
    the most frequent one as a struct (less_n, id), its count negated."""
    member = F.struct("n", "id", "kind")
    groups = (
        pair_dictionary(words)
        .groupBy("prefix", "suffix")
        .agg(F.collect_list(member).alias("members"))
        .where(F.size("members") > 1)
    )
    of = groups.select(F.explode("members").alias("m"), "members")
    kind, own = F.col("m.kind"), F.col("m.id")
    others = F.filter(
        "members",
        lambda x: F.when(kind == CUT, x["kind"] == FIRST_OUT)
        .when(x["kind"] == CUT, kind == FIRST_OUT)
        .otherwise(x["id"] != own),
    )
    found = of.select(own.alias("id"), others.alias("others")).where(F.size("others") > 0)
    best = F.array_min(
        F.transform("others", lambda x: F.struct((-x["n"]).alias("less_n"), x["id"].alias("id")))
    )
    return (
        found.select("id", F.size("others").alias("near"), best.alias("best"))
        .groupBy("id")
        .agg(F.sum("near").alias("n_near"), F.min("best").alias("best"))
    )


def _roots(forms: DataFrame) -> DataFrame:
    """Rows (id, root) of stored rows (id, form): the end of each chain of forms.

    Every round follows twice as many steps. A form is several times as frequent as its
    word, so chains are short and have no loops.
    """
    ends = forms.select("id", F.col("form").alias("root"))
    while True:
        after = ends.select(F.col("id").alias("at"), F.col("root").alias("next"))
        ends = write_through(
            ends.join(after, F.col("root") == F.col("at"), "left").select(
                "id",
                F.coalesce("next", "root").alias("root"),
                F.col("next").isNotNull().alias("moved"),
            ),
            "form-roots",
        )
        if ends.where("moved").isEmpty():
            return ends.select("id", "root")
        ends = ends.drop("moved")


def variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """Rows (word, form, root, n, n_near, form_n), one per row of ``words`` (word, n).

    Two words are near if one letter inserted, deleted or replaced makes one the other. A
    word's form is its near word of the largest n, the smallest in code-point order among
    equals, if that is ``ratio`` times its own n or more; else null. ``root`` is where its
    forms lead, the word itself without a form. Words are unlike each other, not null, and
    of letters up to U+00FF, as ``count_words`` gives them. No words, no rows.
    """
    numbered = write_through(
        words.select("word", F.col("n").cast("bigint").alias("n"))
        .orderBy("word")
        .select(F.monotonically_increasing_id().alias("id"), "word", "n"),
        "words",
    )
    near = write_through(neighbours(numbered), "near-words")
    best_n = -F.col("best.less_n")
    forms = write_through(
        numbered.join(near, "id")
        .where(best_n >= ratio * F.col("n"))
        .select("id", F.col("best.id").alias("form"), best_n.alias("form_n")),
        "forms",
    )
    named = lambda kind: numbered.select(F.col("id").alias(kind), F.col("word").alias(f"{kind}_word"))
    follows = write_through(
        forms.join(_roots(forms), "id").join(named("form"), "form").join(named("root"), "root"),
        "named-forms",
    ).select("id", "form_word", "root_word", "form_n")
    return (
        numbered.join(near.select("id", "n_near"), "id", "left")
        .join(follows, "id", "left")
        .select(
            "word",
            F.col("form_word").alias("form"),
            F.coalesce("root_word", "word").alias("root"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
            "form_n",
        )
    )
