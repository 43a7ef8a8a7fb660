"""SentencePiece BPE encoding by a merge-type prefix table, and decoding.

For every prefix of a text the encoding has exactly one last token, and that
encoding without its last token is the encoding of a shorter prefix.  So one
table entry per position, the prefix's last token, holds the encodings of all
prefixes.  It is filled from left to right: an automaton finds every piece of
the vocabulary that ends at a position, and the one piece is stored that is
compatible with the last token of the prefix before it, that is, whose join
with that token would not have been merged another way.  Ids are then
recovered backwards from the end.  No merge is ever simulated on a text; a
pair's compatibility is found by undoing its merges and remembered.

Texts are cut where no piece can cross (before a run of word marks,
between a letter and punctuation that follows a letter in no piece), so a table is as long as a word and equal
words share it; a text without such places is one long table, whose cost is
linear in its length.

Defined results: a null text is an empty one; an empty text has no ids and
decodes to an empty text.  Word marks that a text holds itself decode to
spaces, as the sentencepiece library's own decoder has it.  Other columns are
ignored; equal rows give equal rows.
"""

from __future__ import annotations

import re
import string
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from risingtide.llm.common import BoundedCache, texts

MARK = "▁"  # fixed value: the library's mark for a space
LETTER = re.compile(r"[^\W\d_]").fullmatch
#: Entries of a worker's caches: some 400 bytes a word, 150 a pair.
CACHED_WORDS, CACHED_PAIRS = 400_000, 1_000_000


class PrefixEncoder:
    """Encoder and decoder of a BPE model with byte fallback, no text
    normalisation and a dummy prefix."""

    def __init__(self, model_file: str):
        sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        if sp.normalize("a  Åb") != f"{MARK}a{MARK}{MARK}Åb":
            raise ValueError("only models without text normalisation are read")
        n = sp.get_piece_size()
        self.pieces = [sp.id_to_piece(i) for i in range(n)]
        special = [sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) for i in range(n)]
        self.bytes = [0] * 256
        for i in range(n):
            if sp.is_byte(i):
                self.bytes[int(self.pieces[i][1:-1], 16)] = i
        self.byte_of = {i: b for b, i in enumerate(self.bytes)}
        self.ids = {p: i for i, p in enumerate(self.pieces) if not special[i]}
        self.length = [len(p) for p in self.pieces]
        # Merges happen in falling order of score; rank 0 is the first.
        ranks = {s: r for r, s in enumerate(sorted({sp.get_score(i) for i in self.ids.values()}, reverse=True), 1)}
        self.rank = [0] * n
        shared = {}
        for p, i in self.ids.items():
            if len(p) > 1:
                self.rank[i] = ranks[sp.get_score(i)]
                shared.setdefault(self.rank[i], []).append(i)
        # Pieces whose rank another piece has too: ties go to the left, which
        # the walk below can't see; their pairs are merged outright.
        self.tied = {i for own in shared.values() if len(own) > 1 for i in own}
        self.split: dict[int, tuple[int, int]] = {}
        self.whole = set()  # pieces that encode to themselves
        for p, i in self.ids.items():
            symbols, last = self._merged(p)
            if symbols == [p]:
                self.whole.add(i)
                if last:
                    self.split[i] = (self.ids[last[0]], self.ids[last[1]])
        self.automaton = ahocorasick.Automaton()
        for p, i in self.ids.items():
            if i in self.whole:
                self.automaton.add_word(p, i)
        self.automaton.make_automaton()
        if any(MARK in p.lstrip(MARK) for p in self.ids):
            raise ValueError("a piece has a word mark inside")
        known = {c for p in self.ids for c in p}
        if any(c not in self.ids for c in known):
            raise ValueError("a piece holds a character that is no piece")
        loose = "" if "\n" in known else "\n"
        # Letters that no piece has in front of ASCII punctuation end a word.
        tied_up = {a for p in self.ids for a, b in zip(p, p[1:], strict=False) if b in string.punctuation}
        letter = f"[^\\W\\d_{re.escape(''.join(sorted(c for c in tied_up if LETTER(c))))}]"
        self.cut = re.compile(f"{MARK}*{letter}++(?![^{MARK}{loose}{re.escape(string.punctuation)}])"
                              f"|{MARK}*[^{MARK}{loose}]+|{MARK}+" + f"|{loose}" * bool(loose)).findall
        self.pairs = BoundedCache(lambda key: self._compatible(*divmod(key, n)), CACHED_PAIRS)
        self.n = n
        self.words = BoundedCache(self._word, CACHED_WORDS)

    def _merged(self, text: str) -> tuple[list[str], tuple[str, str] | None]:
        """Plain merging of a short string: its symbols and the last merge."""
        symbols, last = list(text), None
        while True:
            best = None
            for k in range(len(symbols) - 1):
                i = self.ids.get(symbols[k] + symbols[k + 1])
                if i is not None and (best is None or self.rank[i] < best[0]):
                    best = (self.rank[i], k)
            if best is None:
                return symbols, last
            k = best[1]
            last = (symbols[k], symbols[k + 1])
            symbols[k:k + 2] = [symbols[k] + symbols[k + 1]]

    def _compatible(self, a: int, b: int) -> bool:
        """Whether the text of a and b together is encoded as [a, b].

        Goes back in time from the end: as long as both tokens at the border
        existed, no join of them may have come up.  The token formed last is
        undone first, which uncovers its part at the border.
        """
        if a in self.tied or b in self.tied:
            return self._merged(self.pieces[a] + self.pieces[b])[0] == [self.pieces[a], self.pieces[b]]
        until = (1 << 30, 0)
        while True:
            join = self.ids.get(self.pieces[a] + self.pieces[b])
            # Of equal merges the left one comes first: a join starts right of
            # the merge that ends a's life and left of the one that ends b's.
            if join is not None and (self.rank[join], 1) < until:
                return False
            ra, rb = self.rank[a], self.rank[b]
            if not ra and not rb:
                return True
            if ra > rb:
                until, a = (ra, 0), self.split[a][1]
            else:
                until, b = (rb, 2), self.split[b][0]

    def table(self, s: str) -> list[int]:
        """The last token of each prefix; -1 where a character is in no piece."""
        last, length, pairs, n = [-1] * len(s), self.length, self.pairs, self.n
        for end, t in self.automaton.iter(s):
            if last[end] < 0:
                before = end - length[t]
                # At the start, and after a character in no piece, any piece
                # that encodes to itself will do.
                if before < 0 or last[before] < 0 or pairs[last[before] * n + t]:
                    last[end] = t
        return last

    def _ids(self, s: str) -> list[int]:
        last, out, at = self.table(s), [], len(s) - 1
        while at >= 0:
            t = last[at]
            if t < 0:
                out += [self.bytes[b] for b in reversed(s[at].encode())]
                at -= 1
            else:
                out.append(t)
                at -= self.length[t]
        return out[::-1]

    def _word(self, s: str) -> tuple[list[int], str]:
        ids = self._ids(s)
        return ids, self._surface(ids)

    def _surface(self, ids: list[int]) -> str:
        """Text of ids, word marks as spaces; runs of byte pieces as UTF-8."""
        out, run = [], bytearray()
        for i in ids:
            if i in self.byte_of:
                run.append(self.byte_of[i])
                continue
            if run:
                out.append(run.decode(errors="replace"))
                run.clear()
            out.append(self.pieces[i])
        out.append(run.decode(errors="replace"))
        return "".join(out).replace(MARK, " ")

    def _words(self, text: str) -> list[tuple[list[int], str]]:
        if not text:
            return []
        words = self.words
        return [words[w] for w in self.cut(MARK + text.replace(" ", MARK))]

    def encode(self, text: str) -> list[int]:
        return list(chain.from_iterable(w[0] for w in self._words(text)))

    def encode_and_decode(self, text: str) -> tuple[list[int], str]:
        """Ids, and the text that decoding them gives (word by word: no piece
        crosses a cut, so the words' texts join to the whole)."""
        words = self._words(text)
        ids = list(chain.from_iterable(w[0] for w in words))
        return ids, "".join([w[1] for w in words])[1:]

    def decode(self, ids: list[int]) -> str:
        """The dummy prefix, one space, is taken off the first piece."""
        text = self._surface(ids)
        return text[1:] if ids and self.pieces[ids[0]].startswith(MARK) else text


@lru_cache(maxsize=2)
def encoder(model_file: str) -> PrefixEncoder:
    """One encoder per worker process; its caches outlive a task."""
    return PrefixEncoder(model_file)


def encode_decode(docs: DataFrame, model_file: str) -> DataFrame:
    """doc_id, ids array<int>, decoded string of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(model_file)
        for batch in batches:
            counts, flat, decoded = [0], [], []
            for text in batch.column(1).to_pylist():
                ids, back = enc.encode_and_decode(text or "")
                flat.append(np.array(ids, dtype=np.int32))
                counts.append(counts[-1] + len(ids))
                decoded.append(back)
            ids = pa.ListArray.from_arrays(pa.array(counts, pa.int32()),
                                           pa.array(np.concatenate([np.zeros(0, np.int32), *flat])))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids, pa.array(decoded, pa.string())],
                                             names=["doc_id", "ids", "decoded"])

    return texts(docs).mapInArrow(run, "doc_id long, ids array<int>, decoded string")


def digests(encoded: DataFrame) -> DataFrame:
    ids = F.concat_ws(",", F.col("ids").cast("array<string>"))
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                          F.sha2(ids.cast("binary"), 256).alias("ids_sha256"),
                          F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
