"""Token counts: prefix dynamic programming over a SentencePiece BPE vocabulary.

For every prefix of a text the table holds the exact number of tokens the library gives
for that prefix, so length, truncation and budget questions need no second encoding.

Two facts make this linear. A piece never has a blank after a non-blank, so the encoding
of a text is that of its blank-led words one after the other. And a token sequence is the
BPE encoding of its text exactly if every two neighbours encode to themselves; hence the
last token of a prefix is the one vocabulary entry that ends there and stands validly
after the last token of the prefix before it: ``count[j] = count[j - len(token)] + 1``.
Words repeat, so each worker keeps the columns of words it has seen (bounded, emptied when full).
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLANK = "▁"  # how SentencePiece writes a space
_WORDS_KEPT = 1_000_000
_PAIRS_KEPT = 1_000_000
_PREFIXES_KEPT = 1_000_000
_LONGEST_KEPT = 64
_SHORT = (2, 1)
_CHUNK_CHARS = 1 << 20


class PrefixCounter(dict):
    """Maps a word (led by one blank, written without it) to its prefix counts as uint32 bytes."""

    def __init__(self, model: str):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=model)
        self.score = {sp.id_to_piece(i): sp.get_score(i) for i in range(sp.get_piece_size())
                      if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))}
        sizes: dict[str, set[int]] = {}
        for p in self.score:
            sizes.setdefault(p[-3:], {1, 2}).add(len(p))
        #: last three characters -> lengths of the pieces that end so, longest first
        self.tails = {tail: tuple(sorted(n, reverse=True)) for tail, n in sizes.items()}
        self.valid: dict[str, dict[str, bool]] = {}
        self.pairs = 0
        self.known: dict[str, bytes] = {}
        self.columns: dict[bytes, bytes] = {}
        if any(re.search(f"[^{BLANK}]{BLANK}|\n", p) for p in self.score):
            raise ValueError("pieces that span words: texts cannot be cut at blanks and line breaks")

    def merge(self, text: str) -> list[str]:
        """Plain BPE of a short text: the best pair first, the leftmost of equals."""
        parts, score, none = list(text), self.score.get, float("-inf")
        pairs = [score(a + b, none) for a, b in zip(parts, parts[1:])]
        while pairs and (best := max(pairs)) > none:
            i = pairs.index(best)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            del pairs[i]
            if i < len(pairs):
                pairs[i] = score(parts[i] + parts[i + 1], none)
            if i:
                pairs[i - 1] = score(parts[i - 1] + parts[i], none)
        return parts

    def stands(self, before: str, token: str) -> bool:
        """Do the two tokens (or, after the empty one, a word's first) encode to themselves?"""
        ok = self.merge(before + token) == ([before, token] if before else [token])
        if self.pairs >= _PAIRS_KEPT:
            self.valid.clear()
            self.pairs = 0
        self.pairs += 1
        self.valid.setdefault(before, {})[token] = ok
        return ok

    def last_sizes(self, word: str) -> bytearray:
        """Length of the last token of ``word[:j]``, for j = 1 ... len(word).

        It is the same in every word that starts with that prefix, so the longest prefix
        met before is looked up and only the rest worked out.
        """
        known, valid, tails, score = self.known, self.valid, self.tails, self.score
        if len(known) >= _PREFIXES_KEPT:
            known.clear()
        lo, hi = 0, min(len(word), _LONGEST_KEPT)
        while lo < hi:  # every prefix of a known prefix is known
            mid = (lo + hi + 1) // 2
            if word[:mid] in known:
                lo = mid
            else:
                hi = mid - 1
        sizes = bytearray(known[word[:lo]]) if lo else bytearray()
        for j in range(lo + 1, len(word) + 1):
            for size in tails.get(word[j - 3:j] if j > 3 else word[:j], _SHORT):
                i = j - size
                if i < 0:
                    continue
                token = word[i:j]
                if token not in score and size > 1:
                    continue
                before = word[i - sizes[i - 1]:i] if i else ""
                after = valid.get(before)
                ok = after.get(token) if after else None
                if ok if ok is not None else self.stands(before, token):
                    sizes.append(size)
                    break
            if j <= _LONGEST_KEPT:
                known[word[:j]] = bytes(sizes)
        return sizes

    def column(self, word: str) -> list[int]:
        """Token count of ``word[:j]``, for j = 1 ... len(word)."""
        count, score = [0], self.score
        for j, size in enumerate(self.last_sizes(word), 1):
            # a character without a piece falls back to one token for each of its bytes
            cost = 1 if size > 1 or word[j - 1] in score else len(word[j - 1].encode())
            count.append(count[j - size] + cost)
        return count[1:]

    def __missing__(self, word: str) -> bytes:
        out = array("I", self.column(word if word.startswith("\n") else BLANK + word)).tobytes()
        if len(word) < _LONGEST_KEPT:
            out = self.columns.setdefault(out, out)  # many words share one
            if len(self) >= _WORDS_KEPT:
                self.clear()
                self.columns.clear()
            self[word] = out
        return out

    def words(self, text: str | None) -> list[str]:
        """The words of a text; none if it is empty.

        One that starts with a line break stands as it is, any other is led by a blank that
        is not written. No piece holds a line break, so a text can be cut before it as well.
        """
        if not text:
            return []
        text = text.replace(BLANK, " ")
        words = text.replace("\n", " \n").split(" ")
        if "" in words:  # runs of blanks, or blanks at an end or before a line break
            spans = re.findall(f"{BLANK}+[^{BLANK}\n]*|\n[^{BLANK}\n]*", BLANK + text.replace(" ", BLANK))
            words = [s[1:] if s[0] == BLANK else s for s in spans]
        return words

    def tables(self, texts: Iterable[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Prefix counts of many texts: (counts, starts) for runs of texts of about a million characters.

        ``counts[starts[t] + k]`` is the token count of ``text[:k]``, k = 0 ... len(text).
        """
        run: list[list[str]] = []
        held = 0
        for text in texts:
            run.append(self.words(text))
            held += len(text or "")
            if held >= _CHUNK_CHARS:
                yield self.table(run)
                run, held = [], 0
        if run:
            yield self.table(run)

    def table(self, run: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        own = [self[w] for words in run for w in (words or ("",))]  # an empty text has the empty prefix only
        counts = np.frombuffer(b"".join(own), dtype=np.uint32).astype(np.int64)
        sizes = np.fromiter(map(len, own), dtype=np.int64, count=len(own)) >> 2
        ends = np.cumsum(sizes)
        total = counts[ends - 1]
        before = np.cumsum(total) - total  # tokens of all words before, over the whole run
        first = np.cumsum([0] + [max(1, len(words)) for words in run[:-1]])
        per_text = np.fromiter((max(1, len(words)) for words in run), dtype=np.int64, count=len(run))
        before -= np.repeat(before[first], per_text)
        counts += np.repeat(before, sizes)
        starts = (ends - sizes)[first]
        counts[starts] = 0  # the empty prefix has no tokens, not even the leading blank
        return counts, starts

    def prefix_counts(self, text: str | None) -> np.ndarray:
        """Entry k: tokens of ``text[:k]``, for k = 0 ... len(text)."""
        return self.table([self.words(text)])[0]


_COUNTERS: dict[str, PrefixCounter] = {}


def counter(model: str) -> PrefixCounter:
    if model not in _COUNTERS:
        import public_tokenizers
        _COUNTERS[model] = PrefixCounter(public_tokenizers.path(model))
    return _COUNTERS[model]


def prefix_counts(text: Column, model: str = "piece_bpe_32k.model") -> Column:
    """array<bigint>: the token count of every prefix; NULL and empty text: [0]."""
    @F.pandas_udf("array<bigint>")
    def udf(texts: pd.Series) -> pd.Series:
        c = counter(model)
        return texts.map(c.prefix_counts)
    return udf(text)


def budget(text: Column, limit: int, model: str = "piece_bpe_32k.model") -> Column:
    """struct(n_tokens, fit_chars): all tokens, and the longest prefix (in code points) of at most ``limit`` tokens.

    Both are read off the prefix counts. NULL and empty text: (0, 0).
    """
    @F.pandas_udf("struct<n_tokens: bigint, fit_chars: bigint>")
    def udf(texts: pd.Series) -> pd.DataFrame:
        c = counter(model)
        total, fit = [], []
        for counts, starts in c.tables(texts):
            ends = np.append(starts[1:], len(counts))
            n = counts[ends - 1]
            k = ends - starts - 1
            for t in np.flatnonzero(n > limit):
                # a longer prefix can have fewer tokens, so the last that fits counts
                k[t] = np.flatnonzero(counts[starts[t]:ends[t]] <= limit)[-1]
            total.append(n)
            fit.append(k)
        none = [np.zeros(0, dtype=np.int64)]
        return pd.DataFrame({"n_tokens": np.concatenate(total or none), "fit_chars": np.concatenate(fit or none)})
    return udf(text)


def token_counts(docs: DataFrame, limit: int = 4096, text_col: str = "text", id_col: str = "doc_id",
                 model: str = "piece_bpe_32k.model") -> DataFrame:
    """id, n_bytes, n_tokens, over_limit, fit_chars for each row; no shuffle, rows are independent.

    Repeated rows each give their own row; NULL ids stay NULL; columns of the input other
    than the id are not carried over, so none can clash.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    return (docs.select(F.col(id_col).alias("doc_id"), F.octet_length(text).cast("bigint").alias("n_bytes"),
                        budget(text, limit, model).alias("b"))
            .select("doc_id", "n_bytes", F.col("b.n_tokens").alias("n_tokens"),
                    (F.col("b.n_tokens") > limit).alias("over_limit"), F.col("b.fit_chars").alias("fit_chars")))
