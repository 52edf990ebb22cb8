"""Token ids of whole texts by a ``tokenizers`` file, through word tables.

For a tokenizer that drops white space and splits letters, digits and signs apart, a
text's ids are those of its words in turn, and a word's those of its core and of the signs
behind it. Every block of texts gets a table of distinct words, these one of distinct
cores; each core is encoded once and its ids are joined back by position.
"""

from __future__ import annotations

import json
import os
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from goldrow.llm.pieces import join_back
from goldrow.llm.words import WordTable

#: Words that go to the library in one call.
CALL_WORDS = 1024
#: A word for private use; it sets the words of one call apart.
FENCE = "\ue000"
#: ASCII signs that the tokenizer neither joins to letters nor to digits.
SIGNS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


@lru_cache(maxsize=2)
def _tokenizer(config: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_str(config), [t["content"] for t in json.loads(config)["added_tokens"]]


class Encoder:
    """Ids of word tables; ``config`` is the text of the tokenizer's file."""

    def __init__(self, config: str):
        self.tokenizer, self.special = _tokenizer(config)
        self.fence = np.array(self._ids(FENCE), dtype=np.int32)

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def encode(self, table: WordTable, end: int) -> pa.Array:
        """The ids of each text, then the id ``end``, as lists."""
        cores, tails = self._split(table.words)
        cores, tails = cores.dictionary_encode(), tails.dictionary_encode()
        flat, lengths = self._entries(cores.dictionary.to_pylist())
        tail_flat, tail_lengths = self._entries(tails.dictionary.to_pylist())
        # A word is its core's entry, then its tail's.
        n, words = len(lengths), len(table.words)
        pairs = np.empty(2 * words, np.int64)
        pairs[0::2], pairs[1::2] = cores.indices.to_numpy(), n + tails.indices.to_numpy()
        entries = join_back(
            np.concatenate([flat, tail_flat]),
            np.concatenate([lengths, tail_lengths]),
            pairs,
            np.arange(0, 2 * words + 1, 2),
        )
        flat = np.append(entries.values.to_numpy(), np.int32(end))
        lengths = np.append(np.diff(entries.offsets.to_numpy()), 1)
        codes = np.insert(table.codes, table.starts[1:], words)
        return join_back(flat, lengths, codes, table.starts + np.arange(len(table.starts)))

    def _split(self, words: pa.Array) -> tuple[pa.Array, pa.Array]:
        """Cores and the signs behind them. A word stays whole if it holds a special token,
        or if its core does not end in a letter or digit, which could join the signs."""
        cores = pc.ascii_rtrim(words, characters=SIGNS)
        whole = pc.invert(pc.utf8_is_alnum(pc.utf8_slice_codeunits(cores, -1, None)))
        # The only letter whose small form ends in a mark, which is a sign to the tokenizer.
        for token in [*self.special, "\u0130"]:
            whole = pc.or_(whole, pc.match_substring(words, token))
        cores = pc.if_else(whole, words, cores)
        tails = pc.binary_slice(words.cast(pa.large_binary()), 0, 0).cast(pa.large_string())
        ends = pc.binary_length(words).to_numpy() - pc.binary_length(cores).to_numpy()
        some = np.flatnonzero(ends)
        if len(some):
            picked = words.take(pa.array(some)).to_pylist()
            cut = [w[-k:] for w, k in zip(picked, ends[some].tolist(), strict=True)]
            mask = np.zeros(len(words), bool)
            mask[some] = True
            tails = pc.replace_with_mask(tails, pa.array(mask), pa.array(cut, pa.large_string()))
        # The tokenizer ignores case; of ASCII words that is sure to commute with the rest.
        return pc.if_else(pc.string_is_ascii(cores), pc.ascii_lower(cores), cores), tails

    def _entries(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in turn and the number of ids of each word."""
        flat, lengths = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
        for start in range(0, len(words), CALL_WORDS):
            some = words[start : start + CALL_WORDS]
            own = [i for i, w in enumerate(some) if FENCE in w]
            ids = np.array(
                self._ids(f" {FENCE} ".join("" if FENCE in w else w for w in some)), dtype=np.int32
            )
            cuts = np.flatnonzero(_found(ids, self.fence))
            begins = np.concatenate([[0], cuts + len(self.fence)])
            parts = [ids[b:e] for b, e in zip(begins, [*cuts, len(ids)], strict=True)]
            for i in own:
                parts[i] = np.array(self._ids(some[i]), dtype=np.int32)
            flat += parts
            lengths.append(np.fromiter(map(len, parts), np.int64, len(parts)))
        return np.concatenate(flat), np.concatenate(lengths)


def _found(ids: np.ndarray, run: np.ndarray) -> np.ndarray:
    """Where the run of ids starts."""
    hit = ids == run[0]
    for k in range(1, len(run)):
        hit[:-k] &= ids[k:] == run[k]
        hit[-k:] = False
    return hit
