"""Token ids of whole texts by the tokenizers library, words of a worker encoded once.

A byte-level BPE cuts a text before every word that follows a single space, and before
and after a single line end, so a word with the space or line end before it encodes
alike wherever it stands.  Each worker keeps the ids of the first
pieces it meets (a bounded number; frequent ones are among them) and hands only other
ones to the library, many at a time.  Arrow cuts the texts and finds their different
pieces, so Python meets each of a group's pieces once.  Texts with other runs of white space go to the
library whole, and so do texts that hold the string of an added token (such as ``<|endoftext|>``), which
becomes that token's id, as the library has it.
"""

from __future__ import annotations

import os
import zlib
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: The id that ends a document.
END = 0
#: Pieces that a worker remembers (about 120 MB), bytes that it takes at a time, and
#: words that it hands to the library as one text.
REMEMBERED = 500_000
GROUP_BYTES = 10_000_000
WORDS_A_TEXT = 1000


class Encoder:
    """Ids of texts for one vocabulary file."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks fill the cores
        from tokenizers import Tokenizer

        self._whole = Tokenizer.from_file(path)
        self._added = [t.content for t in self._whole.get_added_tokens_decoder().values()]
        if hasattr(self._whole.model, "_resize_cache"):
            self._whole.model._resize_cache(0)  # no word is asked for twice
        vocab = self._whole.get_vocab()
        self.size = max(vocab.values()) + 1
        self._starts = np.zeros((2, self.size), bool)  # ids that begin with a space, and the line end's
        self._starts[0, [i for t, i in vocab.items() if t.startswith("Ġ")]] = True
        self._starts[1, vocab["Ċ"]] = True
        self._marks = {m: vocab[m] for m in ".,;:!?"}
        self._place: dict[str, int] = {}
        self._stored = 0
        self._ids = np.empty(1 << 16, np.uint32)
        self._from = np.zeros(1 << 16, np.int64)  # piece k has the ids from _from[k] to _from[k + 1]

    def _whole_ids(self, text: str) -> np.ndarray:
        return np.array(self._whole.encode(text, add_special_tokens=False).ids, np.uint32)

    def _learn(self, words: list[str]) -> list[str]:
        """Remember the ids of new words: with a line end before them, or else after a space (not held).

        A word of letters and one mark is cut between them: only its letters go to the library.
        Returns all that is remembered now and was not before.
        """
        if not words:
            return []
        marked = [w for w in words if w[-1] in self._marks and w[w[0] == "\n":-1].isalpha()]
        whole = set(marked)
        plain = list(dict.fromkeys([*(w for w in words if w not in whole),
                                    *(w[:-1] for w in marked if w[:-1] not in self._place)]))
        for after_line, own in enumerate(([w for w in plain if w[0] != "\n"], [w for w in plain if w[0] == "\n"])):
            if own:
                gap = "" if after_line else " "
                parts = [gap + gap.join(own[i:i + WORDS_A_TEXT]) for i in range(0, len(own), WORDS_A_TEXT)]
                encoded = self._whole.encode_batch_fast(parts, add_special_tokens=False)
                ids = np.concatenate([np.array(e.ids, np.uint32) for e in encoded])
                starts = np.flatnonzero(self._starts[after_line, ids])
                assert len(starts) == len(own) and starts[0] == 0
                self._place.update(zip(own, range(self._stored, self._stored + len(own))))
                self._store(ids, starts)
        if marked:
            stem = np.array([self._place[w[:-1]] for w in marked])
            begin, size = self._from[stem], self._from[stem + 1] - self._from[stem] + 1
            starts = np.cumsum(size) - size
            index = np.repeat(begin - starts, size) + np.arange(size.sum())
            ids = self._ids[np.minimum(index, len(self._ids) - 1)]
            ids[starts + size - 1] = [self._marks[w[-1]] for w in marked]
            self._place.update(zip(marked, range(self._stored, self._stored + len(marked))))
            self._store(ids, starts)
        return plain + marked

    def _store(self, ids: np.ndarray, starts: np.ndarray) -> None:
        """Append pieces' ids, end to end, where each piece's begin."""
        known, used = self._stored, int(self._from[self._stored])
        while used + len(ids) > len(self._ids):
            self._ids = np.concatenate([self._ids, np.empty_like(self._ids)])
        while known + len(starts) + 1 > len(self._from):
            self._from = np.concatenate([self._from, np.zeros_like(self._from)])
        self._ids[used:used + len(ids)] = ids
        self._from[known:known + len(starts)] = used + starts
        self._from[known + len(starts)] = used + len(ids)
        self._stored = known + len(starts)

    def encode_batch(self, texts: list[str | None]) -> list[np.ndarray]:
        """The ids of each text (uint32), without an end id; a null text has none."""
        return self.encode_column(pa.array(texts, pa.string()))

    def encode_column(self, texts: pa.Array) -> list[np.ndarray]:
        """``encode_batch`` of an Arrow column of strings."""
        texts = pc.fill_null(texts, "")
        sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
        out: list[np.ndarray] = []
        while len(out) < len(texts):  # groups of a few MB, so that what is new to one group fits the memory
            lo = len(out)
            limit = (sizes[lo - 1] if lo else 0) + GROUP_BYTES
            hi = max(lo + 1, int(np.searchsorted(sizes, limit, "right")))
            out += self._encode_group(texts.slice(lo, hi - lo))
        return out

    def _encode_group(self, texts: pa.Array) -> list[np.ndarray]:
        held = [pc.match_substring(texts, t).to_numpy(zero_copy_only=False) for t in self._added]
        marked = np.flatnonzero(np.logical_or.reduce(held)) if held else np.empty(0, int)
        if len(marked):
            empty = np.zeros(len(texts), bool)
            empty[marked] = True
            out = self._encode_group(pc.if_else(pa.array(empty), "", texts))
            for k in marked.tolist():
                out[k] = self._whole_ids(texts[k].as_py())
            return out
        pieces = pc.split_pattern(pc.replace_substring(texts, "\n", " \n"), " ")
        ends = pieces.offsets.to_numpy().astype(np.int64)
        first = ends[:-1]  # a text's first piece follows no space; every text has one, maybe empty
        coded = pieces.values.dictionary_encode()
        which, words = coded.indices.to_numpy(), coded.dictionary.to_pylist()

        place = self._place
        later = np.ones(len(which), bool)
        later[first] = False
        known = np.fromiter(map(place.get, words, repeat(-1)), np.int64, len(words))
        seen = np.bincount(which[later], minlength=len(words))
        new = np.flatnonzero((known < 0) & (seen > 0)).tolist()
        fresh = [(words[k], seen[k]) for k in new if (w := words[k])
                 and not w[-1].isspace() and not w[w[0] == "\n"].isspace()]
        # once half the memory is full, what a group holds once is not remembered
        least = 2 if len(place) > REMEMBERED // 2 else 1
        before = self._stored
        kept = self._learn([w for w, n in fresh if n >= least])
        remembered = self._stored
        passing = self._learn([w for w, n in fresh if n < least and w not in place])
        known[new] = [place.get(words[k], -1) for k in new]

        at = known[which]
        opening = {k: words[k] for k in which[first].tolist() if words[k] and not words[k][-1].isspace()}
        opened = np.full(len(words), -1, np.int64)
        if opening:  # serves this group alone
            encoded = [e.ids for e in self._whole.encode_batch_fast(list(opening.values()), add_special_tokens=False)]
            opened[list(opening)] = np.arange(self._stored, self._stored + len(encoded))
            sizes = np.array([len(e) for e in encoded])
            self._store(np.array([i for e in encoded for i in e], np.uint32), np.cumsum(sizes) - sizes)
        at[first] = opened[which[first]]

        # texts with other runs of white space go to the library whole
        whole = np.minimum.reduceat(at, first) < 0
        at[np.repeat(whole, np.diff(ends))] = self._stored  # an empty piece
        begin = self._from[at]
        length = np.where(at < self._stored, self._from[np.minimum(at + 1, self._stored)] - begin, 0)
        total = np.concatenate([[0], np.cumsum(length)])
        index = np.repeat(begin - total[:-1], length)
        index += np.arange(len(index))
        ids, cuts = self._ids[index], total[ends]
        out = [ids[a:z] for a, z in zip(cuts[:-1], cuts[1:])]
        for k in np.flatnonzero(whole).tolist():
            text = texts[k].as_py()
            out[k] = self._whole_ids(text) if text else np.empty(0, np.uint32)

        if len(place) - len(passing) > REMEMBERED:  # what is too much serves this group alone
            passing, remembered = passing + kept, before
        for w in passing:
            del place[w]
        self._stored = remembered
        return out


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """The worker's encoder of a vocabulary file."""
    return Encoder(path)


def crc32(ids: np.ndarray) -> int:
    """Unsigned crc32 of the ids as little-endian unsigned 32-bit numbers."""
    return zlib.crc32(np.ascontiguousarray(ids, "<u4").tobytes())


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    """Where a public vocabulary file lies (the same on every machine)."""
    import public_tokenizers

    return public_tokenizers.path(name)
