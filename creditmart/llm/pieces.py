"""Exact merge-type (BPE) encoding and decoding with a SentencePiece vocabulary.

The result of merging is found without merging the text. A sequence of tokens is what the merges
would give exactly when each two neighbours survive the merging of their own concatenation, and a
prefix of the text has at most one such sequence. So the encoder takes the longest token that an
Aho-Corasick automaton finds at a position, keeps it if it is compatible with the token before
(checked by re-merging the two, remembered per pair), else the next shorter one; where none fits
the position is marked in a bitfield as failed and the token before it is taken back.

No token of the vocabulary spans the end of a word (a non-blank followed by a blank) or a line
break; this is verified when the vocabulary is loaded. Words are therefore encoded one by one, and
a bounded table keeps those met before.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditmart.llm.common import free_name, prepare, ship, utf8

BLANK = "▁"  # how a vocabulary writes a blank
KEPT_WORDS = 600_000  # entries of the word table of a worker; it is emptied when full
KEPT_PAIRS = 400_000
UNITS = re.compile(" *[^ ]+| +$")


@dataclass
class Vocabulary:
    """Plain content of a SentencePiece BPE model; small (one entry per token) and picklable."""

    ids: dict[str, int]  # ordinary tokens that merging can reach
    scores: dict[str, float]  # all ordinary tokens: what may be merged, and how early
    byte_ids: list[int]
    decoded: list[bytes]  # by id; blanks as spaces, nothing for control tokens
    is_byte: list[bool]
    begin: int
    end: int
    by_word: bool  # no token spans a non-blank and a following blank
    by_line: bool  # no token holds a line break


def merged(symbols: list[str], scores: dict[str, float]) -> list[str]:
    """Merge neighbours, best score first and leftmost among equals, until none can be merged."""
    symbols, none = list(symbols), float("-inf")
    pairs = [scores.get(a + b, none) for a, b in zip(symbols, symbols[1:])]
    while pairs:
        best = max(pairs)
        if best == none:
            break
        at = pairs.index(best)
        del pairs[at]
        symbols[at] += symbols.pop(at + 1)
        if at < len(pairs):
            pairs[at] = scores.get(symbols[at] + symbols[at + 1], none)
        if at:
            pairs[at - 1] = scores.get(symbols[at - 1] + symbols[at], none)
    return symbols


def default_model() -> str:
    """Where the public vocabulary lies that queries use; ``load`` takes any other path."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def load(path: str) -> Vocabulary:
    """Read the model file on the driver; the library is used as a reader of the format only."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids, scores, decoded, is_byte, byte_ids = {}, {}, [], [], [model.unk_id()] * 256
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        is_byte.append(model.is_byte(i))
        if model.is_byte(i):
            byte_ids[int(piece[3:5], 16)] = i
            decoded.append(bytes([int(piece[3:5], 16)]))
        elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
            decoded.append(" ⁇ ".encode() if model.is_unknown(i) else b"")
        else:
            ids[piece], scores[piece] = i, model.get_score(i)
            decoded.append(piece.replace(BLANK, " ").encode())
    reachable = {p: i for p, i in ids.items() if len(p) == 1 or len(merged(list(p), scores)) == 1}
    return Vocabulary(
        reachable, scores, byte_ids, decoded, is_byte, model.bos_id(), model.eos_id(),
        by_word=not any(BLANK in p.lstrip(BLANK) for p in ids), by_line=not any("\n" in p for p in ids))


class Encoder:
    """A worker's encoder: the automaton and the tables of words and pairs met so far."""

    def __init__(self, vocabulary: Vocabulary):
        import ahocorasick

        self.v, self.words, self.heads, self.pairs, self.prefixes = vocabulary, {}, {}, {}, {}
        self.automaton = ahocorasick.Automaton()
        for piece in vocabulary.ids:
            self.automaton.add_word(piece, (piece, len(piece) - 1))
        self.automaton.make_automaton()
        self.bytes4 = [struct.pack("<I", i) for i in range(len(vocabulary.decoded))]

    def compatible(self, left: str, right: str) -> bool:
        """Do both tokens survive the merging of their concatenation?"""
        if len(self.pairs) >= KEPT_PAIRS:
            self.pairs.clear()
        fits = self.pairs[left, right] = merged([*left, *right], self.v.scores) == [left, right]
        return fits

    def shorter(self, piece: str) -> str:
        """The next shorter token that begins a token; empty if there is none."""
        known = self.prefixes.get(piece)
        if known is None:
            ids = self.v.ids
            known = next((piece[:k] for k in range(len(piece) - 1, 0, -1) if piece[:k] in ids or k == 1), "")
            self.prefixes[piece] = known
        return known

    def tokens(self, text: str) -> list[str]:
        """The tokens of a text; characters without a token stay as they are."""
        if text in self.v.ids:
            return [text]
        n, pairs = len(text), self.pairs
        longest = list(text)  # by start
        for last, (piece, before) in self.automaton.iter(text):
            longest[last - before] = piece  # a longer match from the same start comes later
        out: list[str] = []
        failed, at, piece = 0, 0, longest[0]  # bit p of failed: no way on from position p
        while True:
            while piece:
                end = at + len(piece)
                if not failed >> end & 1:
                    if not out:
                        break
                    fits = pairs.get((out[-1], piece))
                    if fits is None:
                        fits = self.compatible(out[-1], piece)
                    if fits:
                        break
                piece = self.shorter(piece)
            if piece:
                out.append(piece)
                at = end
                if at == n:
                    return out
                piece = longest[at]
            else:
                failed |= 1 << at
                piece = out.pop()
                at -= len(piece)
                piece = self.shorter(piece)

    def unit(self, text: str) -> bytes:
        """Ids of a piece of text, four bytes each; absent characters as their UTF-8 bytes."""
        ids, four, single = self.v.ids, self.bytes4, self.v.byte_ids
        return b"".join(
            four[ids[t]] if t in ids else b"".join(four[single[b]] for b in t.encode()) for t in self.tokens(text))

    def encode(self, text: str) -> bytes:
        """Ids of a text with begin and end, as little-endian unsigned 32-bit integers."""
        begin, end = self.bytes4[self.v.begin], self.bytes4[self.v.end]
        if not text:
            return begin + end
        text = text.replace(BLANK, " ")
        if not (self.v.by_word and self.v.by_line):
            return begin + self.unit((" " + text).replace(" ", BLANK)) + end
        words, heads, parts = self.words, self.heads, [begin]
        if len(words) + len(heads) > KEPT_WORDS:
            words.clear()
            heads.clear()
        for number, line in enumerate(text.split("\n")):
            if number:
                parts.append(self.bytes4[self.v.byte_ids[10]])
            else:
                line = " " + line
            pieces = line.split(" ")
            head = pieces[0]
            if head:
                got = heads.get(head)
                if got is None:
                    got = heads[head] = self.unit(head)
                parts.append(got)
            if "" in pieces[1:]:
                for word in UNITS.findall(line[len(head):]):
                    got = heads.get(word)
                    if got is None:
                        got = heads[word] = self.unit(word.replace(" ", BLANK))
                    parts.append(got)
                continue
            for word in pieces[1:]:
                got = words.get(word)
                if got is None:
                    got = words[word] = self.unit(BLANK + word)
                parts.append(got)
        parts.append(end)
        return b"".join(parts)


class Decoder:
    """Ids back to text: blanks for blank signs, without the one put before the text."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary

    def decode(self, ids: bytes) -> str:
        """Bytes that are no UTF-8 become U+FFFD, one for each byte."""
        numbers = memoryview(ids).cast("I").tolist()
        table = self.v.decoded
        out = b"".join([table[i] for i in numbers])
        first = next((i for i in numbers if table[i]), None)
        if first is not None and not self.v.is_byte[first] and out[:1] == b" ":
            out = out[1:]
        try:
            return out.decode()
        except UnicodeDecodeError:
            return _decode_loosely(out)


def _decode_loosely(data: bytes) -> str:
    out, at = [], 0
    while at < len(data):
        for width in (1, 2, 3, 4):
            try:
                out.append(data[at : at + width].decode())
                at += width
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            at += 1
    return "".join(out)


def encode_documents(
    docs: DataFrame, vocabulary: Vocabulary, text: str = "text", ids: str = "ids", n_tokens: str = "n_tokens",
    decoded: str | None = None,
) -> DataFrame:
    """Add the token ids of every whole text, and with ``decoded`` what they decode to.

    ``ids`` is binary: begin id, tokens, end id, as little-endian unsigned 32-bit integers;
    ``n_tokens`` counts all of them. A null or empty text has the begin and end ids only. Repeated
    rows give repeated results; all other columns stay, except that a column named like a result
    is replaced. An empty table gives an empty table.
    """
    spark = prepare(docs.sparkSession)
    shared = ship(spark, vocabulary)  # its size is that of the vocabulary
    both = decoded is not None

    @F.pandas_udf("ids binary, decoded string" if both else "ids binary")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        vocabulary = shared()
        encoder, decoder = Encoder(vocabulary), Decoder(vocabulary)
        for batch in batches:
            coded = [encoder.encode(t.decode("utf-8", "replace") if t else "") for t in batch]
            yield pd.DataFrame({"ids": coded, "decoded": [decoder.decode(c) for c in coded]} if both else {"ids": coded})

    work = free_name(docs, "_encoded")
    out = docs.withColumn(work, encode(utf8(text)))
    out = out.withColumn(ids, F.col(f"{work}.ids"))
    out = out.withColumn(n_tokens, (F.octet_length(F.col(f"{work}.ids")) / 4).cast("long"))
    if both:
        out = out.withColumn(decoded, F.col(f"{work}.decoded"))
    return out.drop(work)
