"""Token ids of whole texts, in Arrow batches, with a memory of the words already encoded."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from stratamart.llm.common import give_back

#: Words remembered per worker, about 30 bytes each, new ones encoded as one text, and such texts encoded at once. Speed only.
MEMORY, TOGETHER, AT_ONCE = 400_000, 128, 16
#: Texts encoded together, by number and by bytes.
TEXTS, CHARS = 4096, 1 << 22
#: How a byte-level vocabulary writes a space.
SPACE = "\u0120"


@dataclass(frozen=True)
class Encoding:
    """A tokenizer file, the text put before a word that follows a space, the id that ends a document, and the
    number of ids there are. `spaced` says that the tokenizer takes a new line for a space."""

    path: str
    before_word: str
    end: int
    vocabulary: int
    spaced: bool = False

    @property
    def id_bytes(self) -> int:
        """Bytes that hold any id."""
        return 2 if self.vocabulary <= 1 << 16 else 4


@lru_cache(maxsize=4)
def _encoder(path: str, before_word: str, spaced: bool) -> _Encoder:
    return _Encoder(path, before_word, spaced)


class _Encoder:
    """Encodes texts word by word where that is exact, else whole.

    A single space between two characters that are no white space always parts tokens (the space goes
    to the following word, or away), so the words at single spaces are encoded once each and looked up. A text with any
    other white space beside a space, or with a special token's text, is encoded whole.

    Known words are an Arrow array beside flat arrays of their ids, so all words of many texts are looked up at once. When
    there are too many, the ones met in most lots of texts stay.
    """

    def __init__(self, path: str, before_word: str, spaced: bool = False) -> None:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task per core already
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.spaced = spaced
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # Which ids hold a space, where the space goes to the following word: as words hold none, such an id opens a word.
        self.opens = None
        if before_word:
            vocabulary = self.tokenizer.get_vocab()
            self.opens = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
            self.opens[[i for token, i in vocabulary.items() if SPACE in token]] = True
        self.words = pa.array([], pa.large_string())
        self.ids, self.sizes, self.met = np.zeros(0, dtype="<u4"), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int32)

    def _plain(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text; offsets are not kept track of, which is faster."""
        return [np.array(found.ids, dtype="<u4") for at in range(0, len(texts), AT_ONCE)
                for found in self.tokenizer.encode_batch_fast(texts[at:at + AT_ONCE], add_special_tokens=False)]

    def _encoded(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words that hold no white space at an end, strung together, and how many each has.

        Some words at a time go through the tokenizer as a text. They are told apart by the ids that open a word, else by
        offsets: a token belongs to the word in which, or in the space before which, its last character lies.
        """
        lots = [words[at:at + TOGETHER] for at in range(0, len(words), TOGETHER)]
        if self.opens is not None and words:
            ids = np.concatenate(self._plain([" " + " ".join(some) for some in lots]))
            opened = np.flatnonzero(self.opens[ids])
            if len(opened) == len(words):
                return ids, np.diff(opened, append=len(ids))
        parts, sizes = [np.zeros(0, dtype="<u4")], [np.zeros(0, dtype=np.int64)]
        for some in lots:
            found = self.tokenizer.encode(" " + " ".join(some), add_special_tokens=False)
            ends = np.fromiter((end for _, end in found.offsets), dtype=np.int64, count=len(found))
            lengths = np.fromiter(map(len, some), dtype=np.int64, count=len(some)) + 1
            owner = np.searchsorted(np.cumsum(lengths) - lengths, ends - 1, side="right") - 1
            parts.append(np.array(found.ids, dtype="<u4"))
            sizes.append(np.bincount(owner, minlength=len(some)))
        return np.concatenate(parts), np.concatenate(sizes)

    def _places(self, words: pa.Array) -> np.ndarray:
        """The places of words among the known ones, to which new ones are added; a word that must not be taken out of
        its text has size -1 there."""
        known = len(self.words)
        coded = pa.chunked_array([self.words, words]).dictionary_encode().chunks[-1]
        self.words = coded.dictionary
        texts = self.words.slice(known).to_numpy(zero_copy_only=False).tolist()
        fit = np.array([bool(w) and w.strip() == w for w in texts], dtype=bool)
        ids, found = self._encoded([w for w, ok in zip(texts, fit) if ok])
        sizes = np.full(len(texts), -1, dtype=np.int64)
        sizes[fit] = found
        self.ids, self.sizes = np.concatenate((self.ids, ids)), np.concatenate((self.sizes, sizes))
        place = coded.indices.to_numpy().astype(np.int64)
        self.met = np.concatenate((self.met, np.zeros(len(texts), dtype=np.int32))) + (np.bincount(place, minlength=len(self.sizes)) > 0)
        return place

    def _forget(self) -> None:
        """Keep the words met most often, the newer of equal ones, when there are too many."""
        if len(self.words) <= MEMORY:
            return
        kept = np.sort(np.lexsort((np.arange(len(self.met)), self.met))[-(MEMORY // 2):])
        held = np.maximum(self.sizes, 0)
        starts = np.cumsum(held) - held
        self.ids, self.sizes = self.ids[_ranges(starts[kept], held[kept])], self.sizes[kept]
        self.words, self.met = self.words.take(pa.array(kept)), self.met[kept]

    def __call__(self, texts: pa.Array) -> list[bytes]:
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        split = pc.split_pattern(pc.replace_substring(texts, "\n", " ") if self.spaced else texts, " ")
        offsets = split.offsets.to_numpy()
        first = np.zeros(len(split.values), dtype=bool)
        first[offsets[:-1]] = True  # no space stands before these, so they are no words to remember
        heads = split.values.filter(pa.array(first)).dictionary_encode()
        at = self._places(pc.if_else(pa.array(first), "", split.values))
        opening = self._plain(heads.dictionary.to_pylist())
        at[first] = len(self.words) + heads.indices.to_numpy()
        sizes = np.concatenate((self.sizes, np.array([len(ids) for ids in opening], dtype=np.int64)))
        flat = np.concatenate((self.ids, *opening))
        count = sizes[at]
        odd = np.flatnonzero(count < 0)
        count[odd] = 0
        np.maximum(sizes, 0, out=sizes)
        every = flat[_ranges((np.cumsum(sizes) - sizes)[at], count)].tobytes()
        self._forget()
        edges = (4 * np.concatenate(([0], np.cumsum(count)))[offsets]).tolist()
        out = [every[a:b] for a, b in zip(edges[:-1], edges[1:])]
        whole = set((np.searchsorted(offsets, odd, side="right") - 1).tolist())
        for special in self.special:
            whole.update(np.flatnonzero(pc.match_substring(texts, special).to_numpy(zero_copy_only=False)).tolist())
        for i in whole:
            out[i] = self._plain([texts[i].as_py()])[0].tobytes()
        return out


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers from each start on, as many as its size, one range after the other."""
    ends = np.cumsum(sizes)
    out = np.repeat(starts - (ends - sizes), sizes)
    out += np.arange(len(out))
    return out


def encoded(batches: Iterator[pa.RecordBatch], encoding: Encoding) -> Iterator[tuple[list, list[bytes]]]:
    """Ids and token ids with the end id, batch by batch, of rows whose first column is `doc_id` and which have a
    `text`. A null text is empty: the end id alone."""
    encode = _encoder(encoding.path, encoding.before_word, encoding.spaced)
    end = np.array([encoding.end], dtype="<u4").tobytes()
    for batch in batches:
        ids, column = batch.column(0).to_pylist(), batch.column("text")
        chars = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        at = 0
        while at < len(ids):
            before = chars[at - 1] if at else 0
            stop = max(at + 1, min(at + TEXTS, int(np.searchsorted(chars, before + CHARS, side="right"))))
            yield ids[at:stop], [b + end for b in encode(column.slice(at, stop - at))]
            at = stop
        give_back()
