"""Bulk encoding by ranked tokens, equal to what a tokenizer file gives.

A merge vocabulary whose ids follow the order of its merges can be used as ranks. Texts
that need more than that (special strings, signs beyond the plain blocks, endless white
space) go through the tokenizer itself.
"""

from __future__ import annotations

import re
from array import array
from functools import lru_cache

import numpy as np
import tiktoken
from tokenizers import Tokenizer

from .base import byte_letters, one_thread

#: Signs whose class (letter, number, white space) is the same in every Unicode version since 5.0.
_BEYOND = re.compile("[^\x00-\u024f\u0400-\u045f\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fa5]")
_WORD_END = "</w>"
#: Stands for the end of a word in rank form; no plain word holds it.
_END = b"\0"


class TextCoder:
    """Packed ids of whole texts by a byte-level tokenizer file without normalizer."""

    def __init__(self, path: str, pattern: str):
        one_thread()
        self.full = Tokenizer.from_file(path)
        special = {t.content for t in self.full.get_added_tokens_decoder().values()}
        letters = byte_letters()
        words = self.full.get_vocab(with_added_tokens=False).items()
        ranks = {bytes(letters[c] for c in word): i for word, i in words if word not in special}
        self.special = re.compile("|".join(map(re.escape, special))).search if special else lambda text: None
        self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        if not self.special(text) and (text.isascii() or not _BEYOND.search(text)):
            try:
                return self.fast.encode_to_numpy(text).astype("<u4", copy=False).tobytes()
            except ValueError:  # a run of white space too long for the pattern
                pass
        return array("I", self.full.encode_batch_fast([text], add_special_tokens=False)[0].ids).tobytes()


@lru_cache(maxsize=2)
def text_coder(path: str, pattern: str) -> TextCoder:
    return TextCoder(path, pattern)


#: Visible signs below U+0130: their own normal form, and each has one lower-case sign.
_PLAIN = re.compile("[!-~\u00a1-\u012f]+").fullmatch
#: The split of the tokenizer for such signs in lower case: endings, letters, single numbers, all else.
_PRE_TOKEN = re.compile(
    "'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00aa\u00b5\u00ba\u00df-\u00f6\u00f8-\u012f]+|[0-9\u00b2\u00b3\u00b9\u00bc-\u00be]"
    "|[!-/:-@\\[-`{-~\u00a1-\u00a9\u00ab-\u00b1\u00b4\u00b6-\u00b8\u00bb\u00bf\u00d7\u00f7]+"
)


class WordCoder:
    """Packed ids of many plain parts at once by a tokenizer file with word ends.

    Tokens that end a word are lower than all merges, so in rank form the sign for the end
    joins the last byte before anything else happens, as in the tokenizer.
    """

    def __init__(self, model: Tokenizer):
        letters, ranks = byte_letters(), {}
        for word, i in model.get_vocab(with_added_tokens=False).items():
            core = word.removesuffix(_WORD_END) or word
            if all(c in letters for c in core):
                ranks[bytes(letters[c] for c in core) + (_END if core != word else b"")] = i
        self.special = tuple(t.content for t in model.get_added_tokens_decoder().values())
        self.fast = tiktoken.Encoding("words", pat_str="[^\x00]+\x00", mergeable_ranks=ranks, special_tokens={})
        self.ends = np.zeros(max(ranks.values()) + 1, bool)
        self.ends[[i for token, i in ranks.items() if len(token) > 1 and token.endswith(_END)]] = True

    def plain(self, part: str) -> bool:
        """Whether ``encode`` takes this part of a text."""
        return _PLAIN(part) is not None and not any(s in part for s in self.special)

    def encode(self, parts: list[str]) -> list[bytes]:
        """One entry per plain part, which may be a word with signs around it."""
        if not parts:
            return []
        marked = _PRE_TOKEN.sub("\\g<0>\0", "\x01".join(parts).lower())
        words = np.cumsum([part.count("\0") for part in marked.split("\x01")])
        ids = self.fast.encode_to_numpy(marked.replace("\x01", ""))
        packed = ids.astype("<u4", copy=False).tobytes()
        cuts = [0, *(4 * (np.flatnonzero(self.ends[ids])[words - 1] + 1)).tolist()]
        return [packed[a:b] for a, b in zip(cuts, cuts[1:])]
