"""Exact token counts by prefix dynamic programming, for byte-level BPE with word ends.

Within a word the encoding of a prefix is its last token after the encoding of a shorter
prefix, and that last token is the only one that may follow there: two neighbouring tokens
stand iff no merge across their border would have come first. So one pass over the word gives
the last token and the exact count of every prefix, without merging anything. Counts add up
over words, since white space ends a word and gives no token; the running sum is the count
at every word end of a text. Where a limit falls inside a word, the counts at its prefixes tell
how much of it fits, so truncation needs no second encoding.

Words repeat, so each Python worker keeps tables of counts it has found, bounded in entries and
in bytes.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Entries and bytes of keys of one generation of a worker's table, and of a key that is kept;
#: dropping entries never changes a count.
TABLE, TABLE_BYTES, KEY_BYTES = 250_000, 8 << 20, 256
_END = "</w>"
#: Printable ASCII needs no library: its letters, digits and the rest are known.
_PLAIN = re.compile(rb"[!-~]+")
#: A character with the marks and vowels that its normal form may swallow.
_CLUSTER = regex.compile(r"(?s:.)[\p{M}\u1160-\u11FF]*")
_PLAIN_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")


class Table(dict):
    """A bounded memo: a full generation becomes the old one, and what is used again moves on."""

    def __init__(self) -> None:
        super().__init__()
        self.old: dict = {}
        self._held = 0

    def __missing__(self, key):
        found = self.old.get(key)
        if found is not None:
            self.keep(key, found)
        return found

    def keep(self, key, value):
        size = len(key)
        if size > KEY_BYTES:
            return value
        if len(self) >= TABLE or self._held + size > TABLE_BYTES:
            self.old = dict(self)
            self.clear()
            self._held = 0
        self[key] = value
        self._held += size
        return value


class WordBpe:
    """Counts of a tokenizer file whose model is BPE with an end-of-word suffix."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        model = content["model"]
        vocab = model["vocab"]
        if model["end_of_word_suffix"] != _END or model.get("dropout"):
            raise ValueError("a BPE model with word ends and without dropout is needed")
        self.special = sorted((t["content"] for t in content["added_tokens"]), key=len, reverse=True)
        self._special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int, int]] = {}
        for rank, (left, right) in enumerate(model["merges"]):
            whole, pair = vocab[left + right], (vocab[left], vocab[right])
            self.rank[pair] = rank
            self.parts.setdefault(whole, (rank, *pair))
        made = {t for t in vocab.values() if self._stands(t)}
        bare = {s: t for s, t in vocab.items() if t in made}
        inner = {s: t for s, t in bare.items() if not s.endswith(_END)}
        # beginnings of tokens that are none themselves, so that a walk knows where to stop
        self.inner = {s[:k]: -1 for s in inner for k in range(1, len(s))} | inner
        self.final = {s[: -len(_END)]: t for s, t in bare.items() if s.endswith(_END)}
        self.longest = max(map(len, self.final))
        self._borders, self._pieces, self._chunks = Table(), Table(), Table()

    def _spine(self, token: int, side: int) -> list[tuple[int, int, float]]:
        """(token, made at, used up at) along the right (2) or left (1) edge of a token."""
        out, until = [], float("inf")
        while True:
            made = self.parts.get(token)
            out.append((token, made[0] if made else -1, until))
            if made is None:
                return out
            until, token = made[0], made[side]

    def _border(self, left: int, right: int, top: float = float("inf")) -> bool:
        """Whether the border between two neighbours outlives every merge below ``top``."""
        for x, x_made, x_used in self._spine(left, 2):
            for y, y_made, y_used in self._spine(right, 1):
                rank = self.rank.get((x, y))
                if rank is not None and rank < top and x_made < rank < x_used and y_made < rank <= y_used:
                    return False
        return True

    def _stands(self, token: int) -> bool:
        """Whether encoding a token's own text gives that token."""
        if token not in self.parts:
            return True
        rank, left, right = self.parts[token]
        return self._stands(left) and self._stands(right) and self._border(left, right, rank)

    def follows(self, left: int, right: int) -> bool:
        known = self._borders[left, right]
        return self._borders.keep((left, right), self._border(left, right)) if known is None else known

    def prefixes(self, piece: str) -> tuple[list[int], list[int]]:
        """Last token and count for every prefix of a byte-level piece, before its word end."""
        n, get, follows = len(piece), self.inner.get, self.follows
        last, count = [-1] * (n + 1), [0] * (n + 1)
        for start in range(n):
            before = last[start]
            for end in range(start + 1, n + 1):
                token = get(piece[start:end])
                if token is None:
                    break
                if token >= 0 and last[end] < 0 and (start == 0 or follows(before, token)):
                    last[end], count[end] = token, count[start] + 1
            if last[start + 1] < 0:  # one symbol is always a token, so each place is reached
                raise ValueError(f"no token ends at {start + 1} of {piece!r}")
        return last, count

    def prefix_counts(self, piece: str) -> list[int]:
        """The exact token count of every prefix of a piece, each taken as a word of its own."""
        last, count = self.prefixes(piece[:-1]) if piece else ([-1], [0])
        out = [0]
        for end in range(1, len(piece) + 1):
            for start in range(max(0, end - self.longest), end):
                token = self.final.get(piece[start:end])
                if token is not None and (start == 0 or self.follows(last[start], token)):
                    out.append(count[start] + 1)
                    break
            else:
                raise ValueError(f"no token ends the word at {end} of {piece!r}")
        return out

    def piece_count(self, piece: str) -> int:
        found = self._pieces[piece]
        return self._pieces.keep(piece, self._whole(piece)) if found is None else found

    def _whole(self, piece: str) -> int:
        if piece in self.final:
            return 1
        last, count = self.prefixes(piece[:-1])
        end = len(piece)
        for start in range(max(1, end - self.longest), end):
            token = self.final.get(piece[start:])
            if token is not None and self.follows(last[start], token):
                return count[start] + 1
        raise ValueError(f"no token ends the word {piece!r}")

    def chunk_count(self, chunk: bytes) -> int:
        """Tokens of a run of bytes without ASCII white space."""
        found = self._chunks[chunk]
        return self._chunks.keep(chunk, self._new_chunk(chunk)) if found is None else found

    def _new_chunk(self, chunk: bytes) -> int:
        if self._special and b"<|" in chunk:
            parts = self._special.split(chunk.decode())
            return sum(1 if p in self.special else self._plain(p.encode()) for p in parts if p)
        return self._plain(chunk)

    def _plain(self, chunk: bytes) -> int:
        if _PLAIN.fullmatch(chunk):
            pieces = _PLAIN_PIECES.findall(chunk.decode().lower())
        else:
            text = self.library.normalizer.normalize_str(chunk.decode())
            pieces = [p for p, _ in self.library.pre_tokenizer.pre_tokenize_str(text)]
        return sum(map(self.piece_count, pieces))

    def text(self, text: str | None, limit: int) -> tuple[int, int, int]:
        """Bytes, tokens, and the bytes of the longest beginning within ``limit`` tokens."""
        data = text.encode() if text else b""
        chunks = data.split()
        known = self._chunks.get
        counts = [known(c) for c in chunks]
        if None in counts:
            counts = [self.chunk_count(c) if n is None else n for c, n in zip(chunks, counts, strict=True)]
        total = sum(counts)
        if total <= limit:
            return len(data), total, len(data)
        running = 0
        for span, n in zip(re.finditer(rb"[^\x20\x09-\x0D]+", data), counts, strict=True):
            if running + n > limit:
                break
            running += n
        return len(data), total, span.start() + self.fitting(span[0], limit - running)

    def fitting(self, chunk: bytes, room: int) -> int:
        """Bytes of the longest beginning of ``chunk`` that takes ``room`` tokens at most.

        A character stays with its combining marks, and a special string is whole or left out.
        """
        kept = 0
        parts = [chunk.decode()]
        if self._special and b"<|" in chunk:
            parts = [p for p in self._special.split(parts[0]) if p]
        for part in parts:
            n = 1 if part in self.special else self._plain(part.encode())
            if n > room:
                return kept + (0 if part in self.special else self._fitting_plain(part, room))
            room -= n
            kept += len(part.encode())
        return kept

    def _fitting_plain(self, text: str, room: int) -> int:
        clusters = _CLUSTER.findall(text)
        normal = [self.library.normalizer.normalize_str(c) for c in clusters]
        whole = self.library.normalizer.normalize_str(text)
        # bytes of the text up to each place of its normal form at which a cluster ends
        upto, place, size = {0: 0}, 0, 0
        for cluster, form in zip(clusters, normal, strict=True):
            place, size = place + len(form), size + len(cluster.encode())
            upto[place] = size
        if "".join(normal) != whole:  # clusters that change each other: every one of them is tried
            ends = list(accumulate(len(c) for c in clusters))
            fits = [e for e in ends if self._plain(text[:e].encode()) <= room]
            return len(text[: max(fits, default=0)].encode())
        best = 0
        for piece, (lo, hi) in self.library.pre_tokenizer.pre_tokenize_str(whole):
            n = self.piece_count(piece)
            if n <= room:
                room -= n
                best = max(best, max((upto[k] for k in range(lo, hi + 1) if k in upto), default=0))
                continue
            if whole[lo] == "'":  # a contraction that is cut is no contraction
                counts = {k: self._plain(whole[lo:k].encode()) for k in range(lo + 1, hi)}
            else:
                at = list(accumulate((len(c.encode()) for c in whole[lo:hi]), initial=0))
                by_byte = self.prefix_counts(piece)
                counts = {lo + k: by_byte[b] for k, b in enumerate(at) if k and b < len(by_byte)}
            return max([best, *(upto[k] for k, c in counts.items() if c <= room and k in upto)])
        return best


@lru_cache(maxsize=2)
def _of_worker(name: str) -> WordBpe:
    import public_tokenizers

    return WordBpe(public_tokenizers.path(name))


def _count_batches(name: str, limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _of_worker(name)
        for batch in batches:
            texts = batch.column(1)
            found = [bpe.text(texts[i].as_py(), limit) for i in range(len(texts))]
            size, tokens, kept = zip(*found, strict=True) if found else ((), (), ())
            columns = [pa.array(x, pa.int64()) for x in (size, tokens, kept)]
            over = pa.array([n > limit for n in tokens], pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *columns[:2], over, columns[2]],
                names=["id", "n_bytes", "n_tokens", "over_limit", "kept_bytes"],
            )

    return run


def token_counts(
    docs: DataFrame,
    tokenizer: str = "word_bpe_49k.json",
    limit: int = 2048,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``id_col``, ``n_bytes``, ``n_tokens``, ``over_limit`` and ``kept_bytes`` of every row.

    ``kept_bytes`` is the longest beginning of the text that takes ``limit`` tokens at most. Null texts
    count as empty: no bytes, no tokens. Rows are independent, so null ids, repeated rows and
    extra columns change nothing; an empty table gives no rows. Special strings inside a text
    count as the library's default does, one token each.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    schema = f"id {kind}, n_bytes long, n_tokens long, over_limit boolean, kept_bytes long"
    return rows.mapInArrow(_count_batches(tokenizer, limit), schema).withColumnRenamed("id", id_col)
