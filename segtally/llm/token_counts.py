"""Token counts by prefix dynamic programming over a public piece vocabulary.

A text becomes pieces "▁word": in such a vocabulary the mark ▁ stands only at
the front of a piece, so no merge crosses from a word into the next mark and
counts add up over words. Within a word the dynamic program stores, for every
prefix, its last token and exact count: a token may follow the last token of the
prefix before it if and only if the two stay apart when merged by themselves, and
exactly one token fits each prefix. The tables of words are kept in each worker.
Truncation and budget questions read the tables; no text is encoded again.

Defined cases: null and "" have 0 tokens; repeated rows give repeated rows; an
empty table gives an empty table; a word of any length takes time in proportion
to its length; other columns are not read, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

MARK = "▁"
#: Words, and parts of words or pairs of tokens, that a worker keeps; the memory is given back when there are more.
KEEP_WORDS, KEEP_PARTS = 300_000, 900_000


class PrefixCounter:
    def __init__(self, model_file: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        ids = range(model.get_piece_size())
        self.score = {model.id_to_piece(i): model.get_score(i) for i in ids if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))}
        if any(MARK in piece.lstrip(MARK) for piece in self.score):
            raise ValueError("a piece has the mark inside; counts would not add up over words")
        #: Beginnings of pieces, and letter pairs inside pieces: where a pair is in no piece, no merge crosses.
        self.begins = {piece[:i] for piece in self.score for i in range(1, len(piece) + 1)}
        self.joined = {piece[i : i + 2] for piece in self.score for i in range(len(piece) - 1)}
        self.apart: dict[tuple[str, str], bool] = {}
        self.counts: dict[str, int] = {}
        self.parts: dict[str, int] = {}

    def merged(self, s: str) -> list[str]:
        """The tokens of a short string: the best pair merges first, the leftmost of equals."""
        parts = list(s)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self.score.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def fits(self, a: str, b: str) -> bool:
        known = self.apart.get((a, b))
        if known is None:
            if len(self.apart) > KEEP_PARTS:
                self.apart.clear()
            known = self.apart[a, b] = self.merged(a + b) == ([a, b] if a else [b])
        return known

    def table(self, word: str) -> list[int]:
        """Exact token count of word[:i] for each i from 0 to its length."""
        score, begins, apart, n = self.score, self.begins, self.apart, len(word)
        last: list[str | None] = [None] * (n + 1)
        count = [0] * (n + 1)
        last[0] = ""
        for start in range(n):
            before = last[start]
            if word[start] not in score:  # outside the vocabulary: one token for each of its bytes, and no merge over it
                last[start + 1], count[start + 1] = "", count[start] + len(word[start].encode("utf-8", "surrogatepass"))
                continue
            for end in range(start + 1, n + 1):
                token = word[start:end]
                if token not in begins:
                    break
                if last[end] is None and token in score:
                    fits = apart.get((before, token))
                    if fits or (fits is None and self.fits(before, token)):
                        last[end], count[end] = token, count[start] + 1
        return count

    def word(self, word: str) -> int:
        """Count of ▁word, as the sum over parts that no merge joins."""
        if len(self.counts) > KEEP_WORDS:
            self.counts.clear()
        if len(self.parts) > KEEP_PARTS:
            self.parts.clear()
        word, joined, n, at = MARK + word, self.joined, 0, 0
        for i in range(1, len(word) + 1):
            if i == len(word) or word[i - 1 : i + 1] not in joined:
                part = word[at:i]
                known = self.parts.get(part)
                if known is None:
                    known = self.parts[part] = self.table(part)[-1]
                n, at = n + known, i
        self.counts[word[1:]] = n
        return n

    @staticmethod
    def split(text: str) -> list[str]:
        """Words without their first mark; joined by marks they give the text."""
        if "  " in text or text[0] == " " or MARK in text:
            return [x[1:] for x in re.findall(f"{MARK}+[^{MARK}]*", MARK + text.replace(" ", MARK))]
        return text.split(" ")

    def count(self, text: str) -> int:
        if not text:
            return 0
        known, total = self.counts.get, 0
        for w in self.split(text):
            n = known(w)
            total += self.word(w) if n is None else n
        return total

    def prefix_counts(self, text: str) -> list[int]:
        """Exact count of text[:i] for each i from 0 to len(text)."""
        out = [0]
        base = 0
        for k, w in enumerate(self.split(text) if text else ()):
            t = self.table(MARK + w)
            out += [base + n for n in (t[1:] if k else t[2:])]
            base += t[-1]
        return out

    def cut(self, text: str, budget: int) -> str:
        """The longest prefix of at most ``budget`` tokens that ends where a word ends, or within the first that is too much."""
        total, at = 0, 0
        for k, w in enumerate(self.split(text) if text else ()):
            n = self.counts.get(w)
            n = self.word(w) if n is None else n
            if total + n > budget:
                t = self.table(MARK + w)
                more = max((i for i in range(len(t)) if total + t[i] <= budget), default=0)
                return text[: at + more - (k == 0)] if more else text[:at]
            total, at = total + n, at + len(w) + (k > 0)
        return text


@lru_cache(maxsize=2)
def counter(model_file: str) -> PrefixCounter:
    return PrefixCounter(model_file)


def count_tokens(docs: DataFrame, model_file: str, limit: int = 4096) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of each row of docs; one pass, no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = counter(model_file)
        for batch in batches:
            text = pc.fill_null(batch.column("text"), "")
            n = pa.array([c.count(x.as_py()) for x in text], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pc.binary_length(text).cast(pa.int64()), n, pc.greater(n, limit)], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")


def truncate(docs: DataFrame, model_file: str, budget: int) -> DataFrame:
    """doc_id and the prefix of each text that holds at most ``budget`` tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = counter(model_file)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([c.cut(x.as_py() or "", budget) for x in batch.column("text")], pa.string())], ["doc_id", "text"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, text string")
