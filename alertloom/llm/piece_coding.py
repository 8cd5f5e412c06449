"""SentencePiece encoding and decoding by a table of each prefix's last token.

For merge-type models without ties, an encoding is right exactly if every two neighbouring
tokens would also be chosen for their own joined text. So each prefix of a word has one last
token: the one piece ending there (found by an automaton over all pieces) that is compatible
with the last token of the prefix before it. The table is filled left to right, and the ids
are read off backwards. Time is linear in the word, however long it is.

No piece holds a space after another character, so a text falls into words that are encoded
alone and remembered. Runs of spaces have pieces of equal, lowest score, which merge last and
from the left: as many of the longest as fit, then the rest by itself.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MODEL = "piece_bpe_32k.model"
SPACE = "▁"
REMEMBERED_WORDS = 600_000
REMEMBERED_PAIRS = 500_000
REMEMBERED_LENGTH = 40
PROBES = ("a", " a  b ", "A\tﬁ\u3000é\n", "\x00 <s>", "𠀀", " " * 15, " " * 45)


class PieceCoder:
    """Encodes and decodes as the sentencepiece library does, without begin and end ids."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        count = model.get_piece_size()
        plain = [
            i
            for i in range(count)
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
        ]
        self.pieces = [model.id_to_piece(i) for i in range(count)]
        self.bytes = {i: int(self.pieces[i][1:-1], 16) for i in range(count) if model.is_byte(i)}
        self.byte_ids = {b: i for i, b in self.bytes.items()}
        self.silent = {i for i in range(count) if model.is_control(i)}
        self.ids = {self.pieces[i]: i for i in plain}
        self.scores = {self.pieces[i]: model.get_score(i) for i in plain}
        runs = [p for p in self.ids if p.strip(SPACE) == ""]
        self.longest_run = max(len(p) for p in runs)
        words = [self.scores[p] for p in self.ids if len(p) > 1 and p.strip(SPACE)]
        least = min(words, default=0.0)
        if (
            len(self.byte_ids) != 256
            or any(SPACE in p.lstrip(SPACE) for p in self.ids)
            or len(set(words)) != len(words)
            or any(self.scores[p] >= least for p in runs if len(p) > 1)
            or any(p.startswith(SPACE * 2) and p.strip(SPACE) for p in self.ids)
        ):
            raise ValueError(f"{path} is not a merge-type model of the kind handled here")
        self.automaton = ahocorasick.Automaton()
        for piece, i in self.ids.items():
            self.automaton.add_word(piece, (i, len(piece)))
        self.automaton.make_automaton()
        self.pairs: dict[tuple[int, int], bool] = {}
        self.words: dict[str, tuple[str, str]] = {}  # ids and what they decode to
        for probe in PROBES:  # normalisation and the leading space are settings of the model
            if self.encode(probe) != model.encode(probe):
                raise ValueError(f"{path} normalises texts in a way not handled here")

    def _merged(self, text: str) -> list[str]:
        """Pieces of a short text by merging the best pair again and again."""
        parts = list(text)  # of equal scores the leftmost goes first
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self.scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def compatible(self, left: int, right: int) -> bool:
        """Whether the joined text of two pieces is encoded as those two; left -1: the start."""
        known = self.pairs.get((left, right))
        if known is None:
            if len(self.pairs) >= REMEMBERED_PAIRS:
                self.pairs.clear()
            own = [self.pieces[right]] if left < 0 else [self.pieces[left], self.pieces[right]]
            known = self.pairs[left, right] = self._merged("".join(own)) == own
        return known

    def _word(self, word: str) -> list[int]:
        """Ids of a word, with one space in front at most."""
        last = [-1] * (len(word) + 1)  # by the prefix's length; -1: no piece ends there
        pairs, compatible = self.pairs, self.compatible
        for end, (token, length) in self.automaton.iter(word):
            end += 1
            if last[end] < 0:
                # A character without a piece never merges: what follows starts afresh.
                left = last[end - length]
                known = pairs.get((left, token))
                if known or (known is None and compatible(left, token)):
                    last[end] = token
        ids: list[int] = []
        end = len(word)
        while end:
            token = last[end]
            if token < 0:
                ids.extend(self.byte_ids[b] for b in reversed(word[end - 1].encode("utf-8")))
                end -= 1
            else:
                ids.append(token)
                end -= len(self.pieces[token])
        ids.reverse()
        return ids

    def _spaces(self, count: int) -> list[int]:
        whole, rest = divmod(count, self.longest_run)
        runs = [SPACE * self.longest_run] * whole + self._merged(SPACE * rest)
        return [self.ids[run] for run in runs]

    def _coded(self, word: str) -> tuple[str, str]:
        """Decimal ids of a space and the word, comma-joined, and what they decode to; remembered if not long."""
        ids = self._word(SPACE + word)
        coded = ",".join(map(str, ids)), self._plain(ids)
        if len(word) <= REMEMBERED_LENGTH:
            if len(self.words) >= REMEMBERED_WORDS:
                self.words.clear()
            self.words[word] = coded
        return coded

    def coded(self, text: str | None) -> tuple[str, str]:
        """The text's decimal ids joined by commas, and the text that these ids decode to."""
        if not text:
            return "", ""
        words = text.replace(SPACE, " ").split(" ")
        known = list(map(self.words.get, words))
        if None in known or "" in words:
            known = self._slowly(words, known)
        ids, plain = zip(*known)
        return ",".join(ids), "".join(plain).removeprefix(" ")

    def _slowly(self, words: list[str], known: list[tuple[str, str] | None]) -> list[tuple[str, str]]:
        """The same with words not remembered, and with runs of spaces (empty words)."""
        found, spaces = [], 1
        space = str(self.ids[SPACE])

        def run(count: int) -> tuple[str, str]:
            ids = self._spaces(count)
            return ",".join(map(str, ids)), self._plain(ids)

        for word, coded in zip(words, known):
            if not word:
                spaces += 1
                continue
            coded = coded or self._coded(word)
            if spaces > 1:
                # The last space of a run stays with the word if the word's first piece has it.
                first, _, rest = coded[0].partition(",")
                if first == space:
                    found.append(run(spaces))
                    coded = rest, coded[1].removeprefix(" ")
                else:
                    found.append(run(spaces - 1))
                spaces = 1
            found.append(coded)
        if spaces > 1:  # after the last word
            found.append(run(spaces - 1))
        return found

    def encode(self, text: str | None) -> list[int]:
        coded = self.coded(text)[0]
        return list(map(int, coded.split(","))) if coded else []

    def _plain(self, ids: list[int]) -> str:
        """Decoded text, with the space that stands before the first word."""
        if not any(i in self.bytes for i in ids):
            return "".join("" if i in self.silent else self.pieces[i] for i in ids).replace(SPACE, " ")
        raw = b"".join(
            bytes([self.bytes[i]])
            if i in self.bytes
            else b"" if i in self.silent else self.pieces[i].replace(SPACE, " ").encode("utf-8")
            for i in ids
        )
        return raw.decode("utf-8", "replace")

    def decode(self, ids: list[int]) -> str:
        return self._plain(ids).removeprefix(" ")


@lru_cache(maxsize=2)
def coder(path: str) -> PieceCoder:
    """One coder for each worker process; its remembered words serve all its tasks."""
    return PieceCoder(path)


def _default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(MODEL)


def _worker_path(path: str | None) -> str:
    """`path` must be readable on every executor; 'files:NAME' is a file added to the session."""
    if path is None:
        return _default_path()
    return SparkFiles.get(path.removeprefix("files:")) if path.startswith("files:") else path


def encode(docs: DataFrame, model: str | None = None) -> DataFrame:
    """(doc_id, ids array<int>, decoded) of every row. A null text counts as empty: no ids, ''."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(_worker_path(model))
        for batch in batches:
            # Ids go out in small batches: they take several times the space of their text.
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                ids, decoded = [], []
                for text in part.column(1):
                    ids.append(own.encode(text.as_py()))
                    decoded.append(own.decode(ids[-1]))
                yield pa.record_batch(
                    {
                        "doc_id": part.column(0),
                        "ids": pa.array(ids, pa.list_(pa.int32())),
                        "decoded": pa.array(decoded, pa.string()),
                    }
                )

    return _texts(docs).mapInArrow(run, "doc_id long, ids array<int>, decoded string")


def digests(docs: DataFrame, model: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row, made where the ids are.

    ids_sha256 is of the decimal ids joined by commas, decoded_sha256 of the decoded text in
    UTF-8. Null texts count as empty; repeated rows and null doc_ids give a row each.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(_worker_path(model))
        for batch in batches:
            counts, of_ids, of_texts = [], [], []
            for text in batch.column(1):
                coded, plain = own.coded(text.as_py())
                counts.append(coded.count(",") + 1 if coded else 0)
                of_ids.append(hashlib.sha256(coded.encode()).hexdigest())
                of_texts.append(hashlib.sha256(plain.encode("utf-8")).hexdigest())
            yield pa.record_batch(
                {
                    "doc_id": batch.column(0),
                    "n_tokens": pa.array(counts, pa.int64()),
                    "ids_sha256": pa.array(of_ids, pa.string()),
                    "decoded_sha256": pa.array(of_texts, pa.string()),
                }
            )

    return _texts(docs).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
