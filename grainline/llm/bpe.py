"""Byte-level BPE by a dynamic programme over prefixes, and back to text.

Every prefix of a word has exactly one encoding, and that encoding ends in one
token.  An automaton over the vocabulary reports the tokens that end at each
byte; the one whose pair with the last token before it survives merging is the
prefix's last token.  Following these tokens back from the end gives the ids.
"""

from __future__ import annotations

import gc
import json
import weakref
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainline.llm.common import bound_batches, hex_sha256, texts_of

SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"

#: Entries kept of what is already encoded, per task and kind of entry, and the
#: code points of the longest pieces kept.  Tasks of an executor run side by side,
#: each with its own entries; what isn't kept is encoded again.
WORDS_KEPT = 160_000
LONGEST_KEPT = 64

#: Fixed by the tokenizer: how it splits a text before merging.
SPLIT = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+"
    r"| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)

#: Fixed by the tokenizer: letters and numbers of later editions of Unicode,
#: which it takes for signs.
LATE = (
    "\u0558\u058b-\u058c\u088f\u0c5c\u0cdc\u208f\u209d-\u209f\ua7ce-\ua7cf\ua7d2\ua7d4\ua7dd\ua7e2\ua7f1"
    "\uab6c-\uab6d\U000107bb-\U000107bf\U00010940-\U00010959\U00010ec5-\U00010ec7\U00010ed9-\U00010eee"
    "\U00011b0a\U00011db0-\U00011ddb\U00011de0-\U00011de9\U00011df1\U0001246f\U00012475-\U0001247f"
    "\U00012550-\U00012686\U00016ea0-\U00016eb8\U00016ebb-\U00016ed3\U00016ff2-\U00016ff6"
    "\U000187f8-\U000187ff\U00018cd6-\U00018cda\U00018d09-\U00018d20\U00018d80-\U00018df2"
    "\U00018e00-\U00019191\U000191a0-\U000191d2\U0001b123-\U0001b128\U0001b168\U0001d6a6"
    "\U0001df1f-\U0001df24\U0001df2b-\U0001df81\U0001df90-\U0001df96\U0001dfcd-\U0001dfff"
    "\U0001e6c0-\U0001e6de\U0001e6e0-\U0001e6e2\U0001e6e4-\U0001e6e5\U0001e6e7-\U0001e6ed"
    "\U0001e6f0-\U0001e6f4\U0001e6fe-\U0001e6ff\U0002b73a-\U0002b73f\U0002b81e\U0002cea2-\U0002cead"
    "\U000323b0-\U00033479\U0003d000-\U0003fc3f"
)
SPLIT_EXACTLY = (
    "(?V1)"
    + SPLIT.replace(r"[^\p{White_Space}\p{L}\p{N}]", rf"[[^\p{{White_Space}}\p{{L}}\p{{N}}]||[{LATE}]]")
    .replace(r" ?\p{L}+", rf" ?[\p{{L}}--[{LATE}]]+")
    .replace(r" ?\p{N}+", rf" ?[\p{{N}}--[{LATE}]]+")
)


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in a byte-level vocabulary.

    Printable bytes stand for themselves, the others follow from 256 on.
    """
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Encoder:
    """Encodes and decodes with the vocabulary of a tokenizer file."""

    def __init__(self, definition: bytes):
        given = json.loads(definition)
        model, letters = given["model"], byte_letters()
        raw = lambda token: bytes(letters[c] for c in token)
        vocab = model["vocab"]
        self.added = {x["content"]: x["id"] for x in given["added_tokens"]}
        self.by_name = {str(i): raw(t) for t, i in vocab.items()}
        self.by_name |= {str(i): t.encode() for t, i in self.added.items()}
        n = 1 + max(vocab.values(), default=-1)
        #: By id: the merge that makes a token (-1: none), its two parts, its bytes.
        self.rank, self.left, self.right, self.sizes = ([-1] * n for _ in range(4))
        self.merge: dict[int, int] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            made, left, right = vocab[left + right], vocab[left], vocab[right]
            self.merge.setdefault(left << 32 | right, rank)
            if self.rank[made] < 0:
                self.rank[made], self.left[made], self.right[made] = rank, left, right
        self.pairs: dict[int, bool] = {}
        self.ends = ahocorasick.Automaton()
        for token, i in vocab.items():
            if self.rank[i] < 0 or self._apart(self.left[i], self.right[i], before=self.rank[i]):
                data = raw(token).decode("latin-1")
                self.ends.add_word(data, i)
                self.sizes[i] = len(data)
        self.ends.make_automaton()
        self.split = regex.compile(SPLIT).findall
        self.split_exactly = regex.compile(SPLIT_EXACTLY).findall
        self.specials = None
        if self.added:
            longest = sorted(map(regex.escape, self.added), key=len, reverse=True)
            self.specials = regex.compile("(" + "|".join(longest) + ")")
        self.words: dict[str, str] = {}
        self.chunks = Chunks(weakref.proxy(self))  # no cycle: freed when the task ends

    def _apart(self, left: int, right: int, before: float = float("inf")) -> bool:
        """Whether no merge of a rank under `before` joins the end of `left` to
        the start of `right`.

        The pieces that touch the border are undone from the latest merge to
        the first; a border merge counts if it comes while both pieces exist.
        A piece on the left is gone once its own next merge has come, for equal
        ranks too, as merging goes from left to right.
        """
        until_left = until_right = before
        while True:
            joined = self.merge.get(left << 32 | right)
            if joined is not None and joined < until_left and joined <= until_right and joined < before:
                return False
            a, b = self.rank[left], self.rank[right]
            if a < 0 and b < 0:
                return True
            if a > b:
                until_left, left = min(a, until_left), self.right[left]
            else:
                until_right, right = min(b, until_right), self.left[right]

    def ids(self, word: str) -> list[int]:
        """Ids of one word, by the last token of each of its prefixes.

        `word` has a letter for each byte.
        """
        n = len(word)
        whole = self.ends.get(word, None)
        if whole is not None:
            return [whole]
        last = [-1] * (n + 1)
        pairs, sizes = self.pairs, self.sizes
        for at, token in self.ends.iter(word):
            end = at + 1
            if last[end] < 0:
                start = end - sizes[token]
                if start:
                    pair = last[start] << 32 | token
                    fits = pairs.get(pair)
                    if fits is None:
                        if len(pairs) >= WORDS_KEPT:
                            pairs.clear()
                        fits = pairs[pair] = self._apart(last[start], token)
                    if not fits:
                        continue
                last[end] = token
        out = []
        while n:
            out.append(last[n])
            n -= sizes[last[n]]
        return out[::-1]

    def split_words(self, text: str) -> list[str]:
        if text and max(text) >= LATE[0]:
            return self.split_exactly(text)
        return self.split(text)

    def _numbers(self, word: str) -> str:
        return "".join([f",{i}" for i in self.ids(word.encode().decode("latin-1"))])

    def _word(self, word: str) -> str:
        got = self.words.get(word)
        if got is None:
            got = self._numbers(word)
            if len(word) <= LONGEST_KEPT:
                if len(self.words) >= WORDS_KEPT:
                    self.words.clear()
                self.words[word] = got
        return got

    def chunk(self, chunk: str) -> str:
        """The ids of a piece that follows a space; a word alone isn't kept twice."""
        if chunk.isalpha():
            word = " " + chunk
            return self.words.get(word) or self._numbers(word)
        if chunk[-1] in ",." and chunk[:-1].isalpha():
            return self._word(" " + chunk[:-1]) + self._word(chunk[-1])
        return "".join(map(self._word, self.split_words(" " + chunk)))

    def _plain(self, text: str) -> str:
        """A space before anything but white space always starts a word, so the
        text is cut there and the pieces are looked up; a text with other runs
        of white space is split as a whole.
        """
        first, *chunks = text.split(" ")
        try:
            return "".join(map(self._word, self.split_words(first))) + "".join(
                map(self.chunks.__getitem__, chunks)
            )
        except NotCutHere:
            return "".join(map(self._word, self.split_words(text)))

    def encode(self, text: str) -> list[str]:
        """The ids of `text`, in decimal."""
        if self.specials is None or not self.specials.search(text):
            numbers = self._plain(text)
        else:
            parts = self.specials.split(text)
            numbers = "".join([f",{self.added[x]}" if i % 2 else self._plain(x) for i, x in enumerate(parts)])
        return numbers[1:].split(",") if numbers else []

    def decode(self, ids: list[str]) -> bytes:
        """The text of decimal ids, in UTF-8; what isn't UTF-8 is replaced."""
        data = b"".join(map(self.by_name.__getitem__, ids))
        return data.decode(errors="replace").encode()


class NotCutHere(Exception):
    """A piece starts with white space, so its text can't be cut before it."""


class Chunks(dict):
    """Encoded pieces that follow a space: the latest, and those met before them."""

    def __init__(self, encoder: Encoder):
        super().__init__()
        self.encoder = encoder
        self.before: dict[str, str] = {}

    def __missing__(self, chunk: str) -> str:
        got = self.before.get(chunk)
        if got is None:
            if not chunk or chunk[0].isspace():
                raise NotCutHere
            got = self.encoder.chunk(chunk)
            if len(chunk) > LONGEST_KEPT:
                return got
        if len(self) >= WORDS_KEPT:
            self.before = dict(self)
            self.clear()
        self[chunk] = got
        return got


def encode(docs: DataFrame, definition: bytes) -> DataFrame:
    """Each text's number of ids, and digests of the ids and of the text decoded
    from them.

    `definition` is the content of a tokenizer file; it is a few MB at most and
    is sent to the executors.  A null text counts as empty: no ids, and the
    digests of nothing.  Rows are worked on one by one: repeated rows give
    repeated results, further columns of `docs` are not returned, and a text
    may be of any length.  A null doc_id stays null.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    shared = spark.sparkContext.broadcast(definition)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.disable()  # the kept words form no cycles, and collecting walks them all
        try:
            yield from rows(Encoder(shared.value), batches)
        finally:
            gc.enable()

    def rows(encoder: Encoder, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, ids, texts = [], [], []
            for data in texts_of(batch.column(1)):
                numbers = encoder.encode(data.decode())
                counts.append(len(numbers))
                ids.append(hex_sha256(",".join(numbers).encode()))
                texts.append(hex_sha256(encoder.decode(numbers)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids, pa.string()), pa.array(texts, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, SCHEMA)
