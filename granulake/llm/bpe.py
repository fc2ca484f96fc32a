"""Operator 4: BPE encoding and decoding by a prefix-sharing trie.

Merging the lowest-ranked pair first leaves exactly one last token for every
prefix of a word, and a row of tokens is a word's encoding if and only if every
two neighbours stay apart when merged on their own. So the words a batch adds
are put into a trie, and a depth-first walk carries, for each node, the last
token of the path down to it: the one token that ends there and stays apart from
the last token of the path before it. What two words share at their start is
encoded once, and time is linear in the length of a word.

Spark deals out the documents; a task keeps the words it has met (at most
`KNOWN_WORDS`, then it starts afresh), so nothing is shuffled or collected.

Null text: encoded as empty. Empty text: no ids, empty decoded text. Repeated
rows: each gives its own row. Other columns pass through, whatever their names.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granulake.llm.common import pieces

#: Words a task remembers at most, unless told otherwise.
KNOWN_WORDS = 600_000
#: Words put into a trie at a time.
TRIE_WORDS = 10_000
#: Bytes of text handled at a time.
PIECE_BYTES = 1_000_000


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies.

    Printable Latin-1 characters stand for themselves; the others, in order,
    for the characters from code point 256 on.
    """
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {b: chr(b) for b in own}
    rest = [b for b in range(256) if b not in letters]
    letters.update({b: chr(256 + i) for i, b in enumerate(rest)})
    return [letters[b] for b in range(256)]


class WordBpe:
    """A vocabulary whose words end in a marked symbol, read from a tokenizer file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.end = model["end_of_word_suffix"]
        self.id_of: dict[str, int] = model["vocab"]
        self.token_of = {i: t for t, i in self.id_of.items()}
        self.special = {a["content"]: a["id"] for a in spec["added_tokens"]}
        self.token_of |= {i: t for t, i in self.special.items()}
        # By token: the two tokens it is merged from, and the rank of that merge.
        self.halves: dict[str, tuple[str, str]] = {}
        self.rank: dict[str, int] = {}
        for order, (left, right) in enumerate(model["merges"]):
            self.halves.setdefault(left + right, (left, right))
            self.rank.setdefault(left + right, order)
        self.longest = max(len(t.removesuffix(self.end)) for t in self.id_of)
        self.letters = byte_letters()
        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.word_pattern = regex.compile(split)
        self.special_pattern = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        self.apart: dict[tuple[str, str], bool] = {}
        self.known: dict[str, tuple[int, ...]] = {}
        self.known_words = KNOWN_WORDS
        self.texts: pa.Array | None = None

    def _stay_apart(self, left: str, right: str) -> bool:
        """Whether no merge reaches over the border of two neighbouring tokens.

        Both are taken back merge by merge, the later merge first. At each step
        the two pieces that touch must not have a merge that comes before the
        next step: earlier rank, or the same rank and further left.
        """
        known = self.apart.get((left, right))
        if known is not None:
            return known
        rank, halves = self.rank, self.halves
        a, b, answer = left, right, True
        limit, ties_allowed = len(rank), False
        while True:
            joined = a + b
            if halves.get(joined) == (a, b) and (rank[joined] < limit or ties_allowed and rank[joined] == limit):
                answer = False
                break
            of_a, of_b = rank.get(a, -1), rank.get(b, -1)
            if of_a < 0 and of_b < 0:
                break
            if of_a > of_b:
                limit, ties_allowed, a = of_a, False, halves[a][1]
            else:
                limit, ties_allowed, b = of_b, True, halves[b][0]
        self.apart[left, right] = answer
        return answer

    def _last_token(self, tail: str, lasts: list[tuple[str, int]], depth: int, end: str) -> tuple[str, int]:
        """The last token of a path of letters that ends in `tail`, and the depth at which it starts."""
        tokens, apart = self.id_of, self.apart
        ahead = depth - len(tail)
        for cut in range(len(tail) - 1, -1, -1):
            token = tail[cut:] + end
            if token in tokens:
                start = ahead + cut
                if not start:
                    return token, 0
                before = lasts[start - 1][0]
                fits = apart.get((before, token))
                if fits or fits is None and self._stay_apart(before, token):
                    return token, start
        raise ValueError(f"no token ends at {tail!r}")

    def learn(self, new_words: set[str]) -> None:
        """Encode words together and remember their ids."""
        if len(self.known) + len(new_words) > self.known_words:
            self.known = {}
            self.apart = {}
        # neighbours share most, so little is lost by a trie for some of them at a time
        ordered = sorted(new_words)
        for start in range(0, len(ordered), TRIE_WORDS):
            self._learn(ordered[start : start + TRIE_WORDS])

    def _learn(self, new_words: list[str]) -> None:
        trie: dict = {}
        for word in new_words:
            node = trie
            for byte in word.encode("utf-8", "surrogatepass"):
                below = node.get(byte)
                if below is None:
                    below = node[byte] = {}
                node = below
            node[-1] = word
        letters, longest, last_token, end = self.letters, self.longest, self._last_token, self.end
        lasts: list[tuple[str, int]] = []
        waiting = [("", 1, b, child) for b, child in trie.items()]
        while waiting:
            above, depth, byte, node = waiting.pop()
            del lasts[depth - 1 :]
            tail = (above + letters[byte])[-longest:]
            word = node.pop(-1, None)
            if word is not None:
                self.known[word] = self._ids(last_token(tail, lasts, depth, end), lasts)
            if node:
                lasts.append(last_token(tail, lasts, depth, ""))
                waiting.extend([(tail, depth + 1, b, child) for b, child in node.items()])

    def _ids(self, last: tuple[str, int], lasts: list[tuple[str, int]]) -> tuple[int, ...]:
        token, start = last
        tokens = [token]
        while start:
            token, start = lasts[start - 1]
            tokens.append(token)
        return tuple([self.id_of[t] for t in reversed(tokens)])

    def split(self, text: str) -> list[str]:
        """Words of a text in normal form; special tokens stand alone."""
        found: list[str] = []
        for part in self.special_pattern.split(text):
            if part in self.special:
                found.append(part)
            elif part:
                part = unicodedata.normalize("NFC", part)
                # one character at a time where lowering looks at neighbours
                part = "".join(map(str.lower, part)) if "Σ" in part else part.lower()
                found.extend(self.word_pattern.findall(part))
        return found

    def encode_batch(self, texts: list[str]) -> pa.ListArray:
        """Ids of each text."""
        split = [self.split(t) for t in texts]
        needed = set(chain.from_iterable(split)) - self.special.keys()
        new = needed - self.known.keys()
        if new:
            kept = self.known
            self.learn(new)
            if self.known is not kept:  # started afresh: what this batch needs, again
                self.learn(needed - self.known.keys())
        self.known.update({s: (i,) for s, i in self.special.items()})
        of = self.known.__getitem__
        rows = [list(chain.from_iterable(map(of, words))) for words in split]
        ends = np.cumsum([0, *map(len, rows)], dtype=np.int64)
        ids = np.fromiter(chain.from_iterable(rows), dtype=np.int32, count=int(ends[-1]))
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids))

    def decode_batch(self, ids: pa.ListArray) -> pa.Array:
        """Token texts joined by a space, as a vocabulary without a decoder has it; unknown ids are left out."""
        if self.texts is None:
            self.texts = pa.array([self.token_of.get(i) for i in range(max(self.token_of) + 1)], pa.string())
        flat = ids.flatten()
        inside = pc.and_(pc.greater_equal(flat, 0), pc.less(flat, len(self.texts)))
        tokens = self.texts.take(pc.if_else(inside, flat, None))
        # a null list joins to null, a null token is skipped
        rows = pa.ListArray.from_arrays(ids.offsets, tokens)
        return pc.binary_join(rows, " ") if not tokens.null_count else pa.array(
            [" ".join([t for t in row if t is not None]) for row in rows.to_pylist()], pa.string()
        )


@lru_cache(maxsize=2)
def vocabulary(path: str) -> WordBpe:
    """One per Python worker."""
    return WordBpe(path)


def encode_decode(
    docs: DataFrame, path: str, text: str = "text", ids: str = "ids", decoded: str = "decoded", known_words: int | None = None
) -> DataFrame:
    """Each row with the ids of its text and the text these ids decode to.

    `path` names a tokenizer file that every executor has; a task remembers at most
    `known_words` words. Columns already
    called `ids` or `decoded` are replaced.
    """
    kept = [f for f in docs.schema if f.name not in (ids, decoded)]
    out = T.StructType([*kept, T.StructField(ids, T.ArrayType(T.IntegerType())), T.StructField(decoded, T.StringType())])
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(path)
        bpe.known_words = KNOWN_WORDS if known_words is None else known_words
        for batch in batches:
            for piece in pieces(batch, text, PIECE_BYTES):
                coded = bpe.encode_batch([t or "" for t in piece.column(text).to_pylist()])
                columns = [*[piece.column(n) for n in names], coded, bpe.decode_batch(coded)]
                yield pa.RecordBatch.from_arrays(columns, [*names, ids, decoded])

    return docs.select(*[F.col(f"`{n}`") for n in names]).mapInArrow(run, out)
