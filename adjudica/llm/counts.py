"""Exact BPE token counts at every prefix of a text.

For rank-ordered BPE the last token of each prefix is the one vocabulary token that ends
there and may follow the last token of what stands before it; two tokens may follow each
other if encoding their joint bytes gives just these two. So one pass per pre-token gives
the count at each of its prefixes, and sums of pre-token counts extend that to the text.
Truncation and budget questions read those sums; nothing is encoded again.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from .base import Memo, byte_letters, id_and_text, one_thread, text_slices, texts_of
from .bpe import merge_bytes, units_of

PAIRS = 1_000_000
SHORT = 3  # characters of the longest contraction


@lru_cache(maxsize=2)
def _vocabulary(path: str) -> tuple[dict[bytes, int], tuple[str, ...]]:
    one_thread()
    model = Tokenizer.from_file(path)
    special = tuple(t.content for t in model.get_added_tokens_decoder().values())
    letters = byte_letters()
    words = model.get_vocab(with_added_tokens=False).items()
    return {bytes(letters[c] for c in word): i for word, i in words if word not in special}, special


class PrefixCounter:
    """Token counts of all prefixes. ``special`` strings count one each and cut the text."""

    def __init__(self, ranks: dict[bytes, int], special: tuple[str, ...], pattern: str):
        self.ranks, self.pieces = ranks, regex.compile(pattern).findall
        self.longest = max(map(len, ranks))
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.tokens = {i: token for token, i in ranks.items()}
        self.width = max(self.tokens) + 2
        self.pairs: dict[int, bool] = {}
        self.memo = Memo()
        self.space = regex.compile(r"\s+")
        self.blank = self.space.fullmatch

    def may_follow(self, left: int, right: int) -> bool:
        """Whether encoding the bytes of both tokens gives just these; ``left`` -1 is the start."""
        if len(self.pairs) >= PAIRS:
            self.pairs.clear()
        pair = [right] if left < 0 else [left, right]
        found = merge_bytes(b"".join(self.tokens[i] for i in pair), self.ranks) == pair
        self.pairs[(left + 1) * self.width + right] = found
        return found

    def prefix_counts(self, piece: bytes, counts: list[int] | None = None, last: list[int] | None = None) -> list[int]:
        """``counts[i]``: the tokens of the first i bytes of a pre-token.

        ``counts`` and ``last`` (last token per prefix) may hold a known beginning and are extended.
        """
        counts = [0] if counts is None else counts
        last = [-1] if last is None else last
        token_id, known, width = self.ranks.get, self.pairs.get, self.width
        for end in range(len(counts), len(piece) + 1):
            for start in range(end - 1, max(-1, end - self.longest - 1), -1):
                token = token_id(piece[start:end])
                if token is None:
                    continue
                fine = known((last[start] + 1) * width + token)
                if fine or (fine is None and self.may_follow(last[start], token)):
                    counts.append(counts[start] + 1)
                    last.append(token)
                    break
            else:
                raise ValueError(f"no token ends at byte {end} of {piece[:40]!r}")
        return counts

    def totals(self, pieces: set[str]) -> dict[str, int]:
        """Token counts of pre-tokens. In sorted order neighbours share the states of their common prefix."""
        out, counts, last, before = {}, [0], [-1], b""
        for raw, piece in sorted((p.encode(), p) for p in pieces):
            same = 0
            for a, b in zip(before, raw):
                if a != b:
                    break
                same += 1
            del counts[same + 1 :], last[same + 1 :]
            out[piece] = self.prefix_counts(raw, counts, last)[-1]
            before = raw
        return out

    def segments(self, text: str) -> Iterator[tuple[str, bool]]:
        """Pieces between special strings, and those strings."""
        at = 0
        for match in self.special.finditer(text) if self.special else ():
            yield text[at : match.start()], False
            yield match.group(), True
            at = match.end()
        yield text[at:], False

    def units(self, text: str) -> list[str]:
        return units if (units := units_of(text)) is not None else self.pieces(text)

    def learn(self, units: set[str]) -> None:
        """Fill the memo for units not in it."""
        new = self.memo.missing(units)
        if self.special:
            self.memo.update((u, 1) for u in new if self.special.fullmatch(u))
            new = [u for u in new if u not in self.memo]
        cut = [self.pieces(u) for u in new]
        known = self.totals({p for pieces in cut for p in pieces})
        self.memo.update((u, sum([known[p] for p in pieces])) for u, pieces in zip(new, cut))

    def running(self, texts: list[str]) -> list[tuple[list[str], list[int]]]:
        """Per text its units and the token count at the end of each."""
        cut = []
        for text in texts:
            if self.special and self.special.search(text):
                parts = [([s] if own else self.units(s)) for s, own in self.segments(text) if s]
                cut.append([u for part in parts for u in part])
            else:
                cut.append(self.units(text))
        self.learn(set().union(*cut))
        get = self.memo.__getitem__
        return [(units, list(accumulate(map(get, units)))) for units in cut]

    def fits(self, units: list[str], ends: list[int], limit: int) -> int:
        """Bytes of the longest prefix, ending between characters, that holds at most ``limit`` tokens.

        Counts grow along unit ends, so the unit that crosses the limit is found by bisection.
        What a cut may change reaches back over white space to the last unit with another
        character, and forward to the next: only these units are looked at, at every cut.
        """
        k = bisect_right(ends, limit)
        first, last = k, k + 1
        while first > 0 and all(map(self.blank, units[first:k])):
            first -= 1
        while last < len(units) and all(map(self.blank, units[k + 1 : last])):
            last += 1
        done = sum(len(u.encode()) for u in units[:first])
        if k == len(units):
            return done + sum(len(u.encode()) for u in units[first:])
        left = limit - (ends[first - 1] if first else 0)
        return done + max((cut for cut, count in self.cuts("".join(units[first:last])) if count <= left), default=0)

    def cuts(self, text: str) -> Iterator[tuple[int, int]]:
        """``(bytes, tokens)`` of every prefix that ends between characters, as texts of their own.

        A cut within a pre-token leaves those before it as they are and counts as that
        pre-token's prefix; white space at the end is one pre-token; the beginning of a short
        pre-token (a contraction) or of a special string is split anew.
        """
        at = tokens = 0  # bytes and tokens before the segment
        before, before_tokens = "", 0  # ordinary text since the last special string
        for segment, own in self.segments(text):
            if own:
                for n in range(1, len(segment)):
                    cut = segment[:n]
                    yield at + len(cut.encode()), before_tokens + self.size(before + cut)
                at, tokens = at + len(segment.encode()), tokens + 1
                yield at, tokens
                before, before_tokens = "", tokens
                continue
            before, before_tokens = segment, tokens
            place = run_end = 0  # characters
            for piece in self.pieces(segment):
                if place >= run_end and (run := self.space.match(segment, place)):
                    run_end = run.end()
                    raw = run.group().encode()
                    yield from self._inside(raw, at, tokens, self.prefix_counts(raw))
                raw = piece.encode()
                counts = self.prefix_counts(raw)
                known = max(0, run_end - place)
                if len(piece) <= SHORT:
                    for n in range(known + 1, len(piece) + 1):
                        yield at + len(piece[:n].encode()), tokens + self.size(piece[:n])
                elif known < len(piece):
                    yield from self._inside(raw, at, tokens, counts, len(piece[:known].encode()))
                place, at, tokens = place + len(piece), at + len(raw), tokens + counts[-1]

    @staticmethod
    def _inside(raw: bytes, at: int, tokens: int, counts: list[int], known: int = 0) -> Iterator[tuple[int, int]]:
        for i in range(known + 1, len(raw) + 1):
            if i == len(raw) or raw[i] & 0xC0 != 0x80:
                yield at + i, tokens + counts[i]

    def size(self, text: str) -> int:
        """Tokens of a text without special strings."""
        return sum(self.prefix_counts(piece.encode())[-1] for piece in self.pieces(text))


@lru_cache(maxsize=2)
def counter(path: str, pattern: str) -> PrefixCounter:
    return PrefixCounter(*_vocabulary(path), pattern)


def count_tokens(
    docs: DataFrame,
    tokenizer_path: str,
    pattern: str,
    limit: int = 1024,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit, fit_bytes`` per row.

    ``fit_bytes`` is the length of the longest prefix, ending between characters, that the
    tokenizer would give at most ``limit`` tokens as a text of its own. Null and empty texts have no
    tokens, null ids stay null, repeated rows each give a row, other columns are not read.
    Narrow: no shuffle; memory is bounded by 4 MB of text (a row at least) and the memos.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(tokenizer_path, pattern)
        for batch in text_slices(batches):
            texts = texts_of(batch)
            sizes = [len(t.encode()) for t in texts]
            found = count.running(texts)
            tokens = [ends[-1] if ends else 0 for _, ends in found]
            fit = [s if n <= limit else count.fits(*f, limit) for s, n, f in zip(sizes, tokens, found)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array(sizes, pa.int64()), pa.array(tokens, pa.int64()),
                    pa.array([n > limit for n in tokens], pa.bool_()), pa.array(fit, pa.int64()),
                ],
                ["doc_id", "n_bytes", "n_tokens", "over_limit", "fit_bytes"],
            )

    return id_and_text(docs, id_col, text_col).mapInArrow(
        run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean, fit_bytes long"
    )
