"""Token ids of whole texts by a public tokenizer file, encoded once per distinct piece.

A text is cut before each single space or line end that follows a character which is not white
space.  The pre-tokenizers used here never join across such a place, so encoding piece by piece (each
with the space or line end before it) gives the ids of the whole text.  Texts that hold white space in
front of a space, a line end or the end, white space beyond ASCII, or the string of an added token
(which the library looks for before anything else, and which gets its own id), are encoded whole.
Arrow cuts the texts of one call and numbers their distinct pieces; those alone are encoded, by the
tokenizers library, and remembered per Python worker: at most ``MOST_PIECES`` and one call's, then
those that only one call held are forgotten.
"""

from __future__ import annotations

import os
import re
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that one call of ``Encoder.encode`` should be given.
ENCODE_BYTES = 1 << 23
#: Pieces that a worker remembers.
MOST_PIECES = 1_000_000
#: Pieces that one call of the library's model is given.
_AT_ONCE = 2048
#: A space, line end or end of text after white space; white space outside ASCII.
_ODD = "[\t\n\x0b\x0c\r ](?:[ \n]|\\z)|[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
#: Marks that may follow a word: pre-tokenizers take a run of them as one piece. Apostrophes are not among them.
_TAIL = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=4)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _words_only(path: str):
    """The vocabulary's model behind a cut at spaces, for pre-tokens that are spelt already."""
    from tokenizers import Tokenizer, pre_tokenizers

    found = Tokenizer(Tokenizer.from_file(path).model)
    if hasattr(found.model, "_resize_cache"):  # distinct pieces never hit it
        found.model._resize_cache(0)
    found.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(" ")
    return found


#: A word of ASCII and Latin-1 letters, which pre-tokenizers keep together and normal forms leave alone, with or without a
#: line end before it and marks behind it.
_PLAIN = "^\n?[A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]+[" + re.escape(_TAIL) + "]*$"


class Encoder:
    """Ids of many texts.  ``lower`` says that the tokenizer drops white space and folds case itself."""

    def __init__(self, path: str, lower: bool):
        self.tokenizer, self.lower = _tokenizer(path), lower
        self.model = _words_only(path)
        # bytes as the vocabulary spells them; 0x00, 0x01 and the space never stand in a plain piece: separator, space, end of pre-token
        letters = _byte_letters()
        self.spelling = np.array([*(ord(letters[b]) for b in range(256))], "<u4")
        self.spelling[1], self.spelling[32] = ord(letters[32]), 32
        vocabulary = sorted(self.tokenizer.get_vocab(False).items(), key=lambda x: x[1])
        self.opens = np.zeros(vocabulary[-1][1] + 1, bool)
        self.closes = self.opens.copy()
        for token, i in vocabulary:
            self.opens[i] = token[0] in (letters[32], letters[10])
            self.closes[i] = token.endswith("</w>")
        self.separator = self.model.encode_batch_fast([letters[0]], add_special_tokens=False)[0].ids[0]
        added = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values() if t.content]
        # one pass over the text finds all that forbids cutting it; added tokens whatever their case, as a normal form may fold it
        self.odd = "|".join([*([] if lower else [_ODD]), *(f"(?i:{a})" for a in added)])

        self.known = pa.array([], pa.string())
        self.ids, self.n, self.calls = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int32)

    def _remember(self, pieces: pa.Array) -> np.ndarray:
        """Numbers of distinct pieces among the known ones, after new ones are encoded."""
        if len(self.known) > MOST_PIECES:
            keep = self.calls > 1
            if keep.sum() > MOST_PIECES:
                keep[:] = False
            self.known, self.ids = self.known.filter(pa.array(keep)), self.ids[np.repeat(keep, self.n)]
            self.n, self.calls = self.n[keep], np.zeros(int(keep.sum()), np.int32)
        place = pc.index_in(pieces, value_set=self.known)
        fresh = pieces.filter(pc.is_null(place))
        place = pc.fill_null(place, -1).to_numpy().astype(np.int64)
        place[place < 0] = len(self.known) + np.arange(len(fresh))
        ids, n = self._encode(fresh, not self.lower)
        self.known = pa.concat_arrays([self.known, fresh])
        self.ids, self.n = np.concatenate((self.ids, ids)), np.concatenate((self.n, n))
        self.calls = np.concatenate((self.calls, np.zeros(len(fresh), np.int32)))
        self.calls[place] += 1
        return place

    def _whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode(self, pieces: pa.Array, lead: bool) -> tuple[np.ndarray, np.ndarray]:
        """(ids in a row, how many each piece has); ``lead``: a space stands before pieces that begin with no line end.

        A plain word, its line end and its marks are the pre-tokens that they are, so they go to the library's model at
        once, between separators; all other pieces go through the whole tokenizer."""
        plain = pc.match_substring_regex(pieces, _PLAIN)
        words = pieces.filter(plain)
        if self.lower:
            words = pc.replace_substring(words, "\n", "")
        parts = pc.replace_substring_regex(words, "([" + re.escape(_TAIL) + "]+)$", " \\1")
        parts = pc.replace_substring(parts, "\n", "\n \x02" if lead else "\n ")
        ends = np.append(np.arange(0, len(parts), _AT_ONCE, dtype=np.int32), np.int32(len(parts)))
        marked = lead or self.lower  # then the ids themselves tell where pieces begin or end
        joined = pc.binary_join(pa.ListArray.from_arrays(ends, parts), " \x01" if lead else " " if marked else " \x00 ").to_pylist()
        if lead:
            joined = [("\x01" + j).replace("\x01\n \x02", "\n ") for j in joined]
        if self.lower:
            joined = [j.lower() for j in joined]
        spelt = [self.spelling[np.frombuffer(j.encode(), np.uint8)].tobytes().decode("utf-32-le") for j in joined]
        close = [] if marked else [self.separator]
        got = [np.array(e.ids + close, np.int32) for e in self.model.encode_batch_fast(spelt, add_special_tokens=False)]
        ids = np.concatenate(got) if got else np.zeros(0, np.int32)
        if lead:
            length = np.diff(np.flatnonzero(self.opens[ids]), append=len(ids))
        elif self.lower:
            n_parts = 1 + pc.match_substring(parts, " ").to_numpy(zero_copy_only=False)
            length = np.diff(np.flatnonzero(self.closes[ids])[np.cumsum(n_parts) - 1], prepend=-1)
        else:
            length = np.diff(np.flatnonzero(ids == self.separator), prepend=-1) - 1
            ids = ids[ids != self.separator]
        if len(words) == len(pieces):
            return ids, length
        mask = plain.to_numpy(zero_copy_only=False)
        others = pieces.filter(pc.invert(plain)).to_pylist()
        rest = self._whole([" " + p if lead and p[:1] != "\n" else p for p in others])
        # both in the order of the pieces
        counts = np.zeros(len(pieces), np.int64)
        counts[mask], counts[~mask] = length, np.fromiter(map(len, rest), np.int64, len(rest))
        own = np.repeat(mask, counts)
        out = np.empty(len(own), np.int32)
        out[own], out[~own] = ids, np.fromiter(chain.from_iterable(rest), np.int32, int(counts[~mask].sum()))
        return out, counts

    def encode(self, texts: pa.Array | list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts (null: empty) in a row, and how many each text has."""
        texts = pc.fill_null(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()), "")
        if not len(texts):
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        odd = pc.match_substring_regex(texts, self.odd) if self.odd else pa.array(np.zeros(len(texts), bool))
        which = np.flatnonzero(odd.to_numpy(zero_copy_only=False))
        whole = self._whole(texts.filter(odd).to_pylist())
        texts = pc.if_else(odd, "", texts)
        cut = pc.split_pattern(pc.replace_substring(texts, "\n", " " if self.lower else " \n"), " ")
        bounds = cut.offsets.to_numpy().astype(np.int64)
        first = bounds[:-1]
        pieces = cut.flatten().dictionary_encode()
        local = self._remember(pieces.dictionary)[pieces.indices.to_numpy()]
        parts = [(self.ids, self.n)]
        if not self.lower:  # a text's first piece has no space before it: it has ids of its own
            heads = pieces.indices.take(pa.array(first)).dictionary_encode()
            local[first] = len(self.n) + heads.indices.to_numpy()
            parts.append(self._encode(pieces.dictionary.take(heads.dictionary), False))
        if whole:
            local[first[which]] = sum(len(n) for _, n in parts) + np.arange(len(whole))
            n = np.fromiter(map(len, whole), np.int64, len(whole))
            parts.append((np.fromiter(chain.from_iterable(whole), np.int32, int(n.sum())), n))
        ids, n = (np.concatenate(x) for x in zip(*parts, strict=True))
        length, begin = n[local], (np.cumsum(n) - n)[local]
        total = np.concatenate(([0], np.cumsum(length)))
        out = ids[np.repeat(begin - total[:-1], length) + np.arange(total[-1])]
        return out, total[bounds[1:]] - total[bounds[:-1]]


def _byte_letters() -> dict[int, str]:
    """Byte-level vocabularies write every byte as one visible letter: printable Latin-1 as itself, the others from U+0100 up."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table = {b: chr(b) for b in seen}
    spare = 256
    for b in range(256):
        if b not in table:
            table[b] = chr(spare)
            spare += 1
    return table


@lru_cache(maxsize=2)
def encoder(path: str, lower: bool) -> Encoder:
    """The worker's encoder for one vocabulary file."""
    return Encoder(path, lower)
