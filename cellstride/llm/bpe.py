"""Byte-pair encoding by backtracking over longest matches, and decoding by an offset table."""

from __future__ import annotations

import json
import re
import string
import sys
from array import array
from collections.abc import Iterator
from functools import cache

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from . import common

#: Splits a text into the pieces that merges stay within (fixed value of this tokenizer family).
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Encoded units, and judged pairs of tokens, that a worker remembers before it starts afresh.
REMEMBERED = 150_000
#: Bytes of texts that are cut and encoded at once; a longer text is taken alone.
CUT_BYTES = 1 << 20


def _byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in the vocabulary file: printable ones for themselves, others from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(rest)}}


def load_vocabulary(path: str) -> dict:
    """Token bytes by id, merges and special tokens of a byte-level BPE file; small enough to broadcast."""
    with open(path, encoding="utf-8") as f:
        data = json.load(f)
    letters = _byte_letters()
    special = {x["content"]: x["id"] for x in data.get("added_tokens", [])}
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in data["model"]["merges"]]
    ids = data["model"]["vocab"]
    tokens = {i: bytes(letters[c] for c in t) for t, i in ids.items() if t not in special}
    return {"tokens": tokens, "special": special, "merges": [(ids[a], ids[b], ids[a + b]) for a, b in merges], "later": later_letters()}


@cache
def later_letters() -> str:
    """Letters and digits that ``regex`` knows and the library does not, as its Unicode tables are older: to the library they
    are symbols.

    The library is asked for the pieces of a text in which each of them follows a letter, and a digit.
    """
    from tokenizers import pre_tokenizers

    splitter, out = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True), []
    for lead, kind in (("a", r"\p{L}"), ("1", r"\p{N}")):
        known = regex.findall(kind, "".join(map(chr, [*range(0x80, 0xD800), *range(0xE000, sys.maxunicode + 1)])))
        begins = {a for _, (a, _) in splitter.pre_tokenize_str("".join(f"!{lead}{c}" for c in known))}
        out += [c for i, c in enumerate(known) if 3 * i + 2 in begins]
    return "".join(sorted(out))


def _byte_kinds() -> dict[str, np.ndarray]:
    """What a byte alone tells: a lone 80 to 8A, 9F, A0, A8, A9 or AF may end a white-space character, C2 and E1 to E3 may begin one."""
    every = np.arange(256)
    shown = (every > 0x20) & (every < 0x7F)
    word = np.isin(every, np.frombuffer(string.ascii_letters.encode() + string.digits.encode(), np.uint8))
    ends = [*range(0x80, 0x8B), 0x9F, 0xA0, 0xA8, 0xA9, 0xAF]
    return {"space": np.isin(every, [0x20, 0x0A]), "line": every == 0x0A, "word": word, "mark": shown & ~word, "pair": (every > 0xC2) & (every < 0xE0),
            "solid": shown | (every > 0x7F) & (every < 0xC0) & ~np.isin(every, ends),
            "begins": shown | (every > 0xC2) & ~np.isin(every, [0xE1, 0xE2, 0xE3])}


KINDS = _byte_kinds()


def cuts(text: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Where units of UTF-8 bytes begin, and the end: at ``at``, and at some places that no piece of ``PIECES`` reaches over.

    Those are a blank or line end behind what is surely no white space, what follows a lone line end, and a mark behind a letter
    or digit.  What is doubtful is not cut, so that a unit holds whole pieces, and gives the same ones by itself.
    """
    n = len(text)
    cut = np.zeros(n + 1, bool)
    if n > 1:
        kind = {name: of[text] for name, of in KINDS.items()}
        solid = kind["solid"]
        solid[1:] |= kind["pair"][:-1]
        cut[1:n] = kind["space"][1:] & solid[:-1] | kind["mark"][1:] & kind["word"][:-1]
        cut[2:n] |= kind["line"][1:-1] & solid[:-2] & kind["begins"][2:]
    cut[at] = cut[n] = True
    return np.flatnonzero(cut)


class Decoder:
    """The offset table: all tokens laid end to end, and where each begins."""

    def __init__(self, vocabulary: dict):
        every = {**vocabulary["tokens"], **{i: t.encode() for t, i in vocabulary["special"].items()}}
        size = max(every) + 1
        self.sizes = np.array([len(every.get(i, b"")) for i in range(size)], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.text = np.frombuffer(b"".join(every.get(i, b"") for i in range(size)), np.uint8)

    def decode(self, ids: np.ndarray) -> str:
        n = self.sizes[ids]
        at = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n - self.starts[ids], n)
        return self.text[at].tobytes().decode("utf-8", "replace")


class Codec(Decoder):
    """Encoder and decoder of one vocabulary; each Python worker builds what it needs."""

    def __init__(self, vocabulary: dict):
        super().__init__(vocabulary)
        self.tokens, self.special = vocabulary["tokens"], vocabulary["special"]
        self.rank, self.left, self.right, self.joined = dict.fromkeys(self.tokens, -1), {}, {}, {}
        for rank, (a, b, whole) in enumerate(vocabulary["merges"]):
            self.joined[a, b] = rank
            if self.rank[whole] < 0:
                self.rank[whole], self.left[whole], self.right[whole] = rank, a, b
        by_text = {t: i for i, t in self.tokens.items() if len(t) == 1 or self.rank[i] >= 0}
        self.by_text = {t.decode("latin-1"): i for t, i in by_text.items()}
        self.longest = max(map(len, by_text))
        self.shorter, self.length = {}, {i: len(t) for i, t in self.tokens.items()}
        self.matches = ahocorasick.Automaton()
        for text, i in by_text.items():
            self.matches.add_word(text.decode("latin-1"), (len(text), i))
            self.shorter[i] = next((by_text[text[:n]] for n in range(len(text) - 1, 0, -1) if text[:n] in by_text), None)
        self.matches.make_automaton()
        self.fits: dict[int, bool] = {}
        self.units: dict[bytes, bytes] = {}
        self.pieces = regex.compile(PIECES)
        later = vocabulary["later"]
        # Most units hold nothing from the first of these letters on, which a plain range tells fast.
        self.high = re.compile(f"[{later[0]}-\U0010ffff]") if later else None
        self.later = regex.compile(f"[{later}]") if later else None
        names = sorted(self.special, key=len, reverse=True)
        self.names = {x.encode(): np.int32(i).tobytes() for x, i in self.special.items()}
        self.split = re.compile(b"|".join(re.escape(x.encode()) for x in names)) if names else None

    def compatible(self, a: int, b: int) -> bool:
        """Whether the merges leave these two tokens side by side.

        Merges are undone from the last one; the pair at the seam must never have one that comes first.
        Of equal merges the left one comes first.
        """
        x, y, limit, rank, fits = a, b, len(self.joined), self.rank, None
        while fits is None:
            if self.joined.get((x, y), limit) < limit:
                fits = False
            elif rank[x] < 0 and rank[y] < 0:
                fits = True
            elif rank[x] > rank[y]:
                limit, x = rank[x], self.right[x]
            else:
                limit, y = rank[y] + 1, self.left[y]
        if len(self.fits) > REMEMBERED:
            self.fits.clear()
        self.fits[a << 20 | b] = fits
        return fits

    def _longest_at(self, text: str, at: int) -> int:
        """The longest token that begins here: down the trie as far as the text leads, then back to the last whole token."""
        part, by_text = text[at:at + self.longest], self.by_text
        for n in range(self.matches.longest_prefix(part), 0, -1):
            token = by_text.get(part[:n])
            if token is not None:
                return token
        raise KeyError(part[:1])

    def encode_piece(self, piece: str) -> list[int]:
        """Take the longest match; where it does not fit behind the last token try shorter ones, else step back."""
        text = piece.encode("utf-8").decode("latin-1")
        fits, longest, compatible = self.fits, self.matches.iter_long, self.compatible
        out: list[int] = []
        last = -1
        for _, (_, token) in longest(text):
            if last >= 0:
                good = fits.get(last << 20 | token)
                if good is None:
                    good = compatible(last, token)
                if not good:
                    break
            out.append(token)
            last = token
        else:
            return out
        length, shorter, dead, n = self.length, self.shorter, set(), len(text)
        at = sum([length[i] for i in out])
        token = shorter[token]
        while True:
            while token is None:
                dead.add(at)
                token = out.pop()
                at -= length[token]
                token = shorter[token]
            end = at + length[token]
            if end not in dead:
                if out:
                    good = fits.get(out[-1] << 20 | token)
                    if good is None:
                        good = compatible(out[-1], token)
                else:
                    good = True
                if good:
                    out.append(token)
                    if end == n:
                        return out
                    at = end
                    token = self._longest_at(text, at)
                    continue
            token = shorter[token]

    def _unit(self, unit: bytes) -> bytes:
        """The ids of a unit, piece by piece."""
        if unit in self.names:
            return self.names[unit]
        if unit.isalpha() or unit[:1] == b" " and unit[1:].isalpha():
            return array("i", self.encode_piece(unit.decode())).tobytes()
        text = unit.decode()
        pieces = self.pieces.findall(text)
        if self.high and self.high.search(text) and self.later.search(text):
            pieces = [text[m.start():m.end()] for m in self.pieces.finditer(self.later.sub("§", text))]
        return array("i", [i for x in pieces for i in self.encode_piece(x)]).tobytes()

    def _units(self, units: list[bytes]) -> list[bytes]:
        """The ids of different units; short ones are remembered."""
        known = self.units
        if len(known) > REMEMBERED:
            known.clear()
        out = [known.get(x) for x in units]
        for i, ids in enumerate(out):
            if ids is None:
                unit = units[i]
                out[i] = ids = self._unit(unit)
                if len(unit) <= 64:
                    known[unit] = ids
        return out

    def _encode_cut(self, texts: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
        """Cut the texts into units, encode the different ones, and lay their ids out in the order of the texts."""
        _, ends, data = texts.buffers()
        ends = np.frombuffer(ends, np.int64)[texts.offset:texts.offset + len(texts) + 1]
        ends, text = ends - ends[0], np.frombuffer(data or b"", np.uint8)[ends[0]:ends[-1]]
        named = {i for x in self.special for i in np.flatnonzero(pc.match_substring(texts, x).to_numpy(zero_copy_only=False))}
        names = [(ends[i] + m.start(), ends[i] + m.end())
                 for i in named for m in self.split.finditer(text[ends[i]:ends[i + 1]].tobytes())]
        at = cuts(text, np.concatenate([ends, np.array(names, np.int64).ravel()]))
        if names:
            within = np.zeros(len(text) + 1, bool)
            for a, b in names:
                within[a + 1:b] = True
            at = at[~within[at]]
        units = pa.Array.from_buffers(pa.large_binary(), len(at) - 1, [None, pa.py_buffer(at), pa.py_buffer(text)])
        units = units.dictionary_encode()
        ids = self._units(units.dictionary.to_pylist())
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        which = units.indices.to_numpy()
        n = sizes[which]
        until = np.concatenate([[0], np.cumsum(n)])
        place = np.arange(until[-1]) - np.repeat(until[:-1] - (np.cumsum(sizes) - sizes)[which], n)
        return np.frombuffer(b"".join(ids), np.int32)[place], until[np.searchsorted(at, ends)]

    def encode_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts end to end, and where each text's begin (and the last end); a null text has none."""
        texts = pc.fill_null(texts, "").cast(pa.large_string())
        bytes_until = np.cumsum(pc.binary_length(texts).to_numpy())
        ids, until, i = [np.zeros(0, np.int32)], [np.zeros(1, np.int64)], 0
        while i < len(texts):
            limit = CUT_BYTES + (bytes_until[i - 1] if i else 0)
            n = max(1, int(np.searchsorted(bytes_until, limit, "right")) - i)
            some, ends = self._encode_cut(texts.slice(i, n))
            ids.append(some)
            until.append(ends[1:] + until[-1][-1])
            i += n
        return np.concatenate(ids), np.concatenate(until)

    def encode(self, text: str | None) -> np.ndarray:
        return self.encode_all(pa.array([text], pa.string()))[0]


#: The codec of this Python worker: one, kept from task to task.
_held: dict[tuple, Decoder] = {}


def _codec(kind: type, path: str, vocabulary) -> Decoder:
    if (kind, path) not in _held:
        _held.clear()
        _held[kind, path] = kind(vocabulary.value)
    return _held[kind, path]


def _over(df: DataFrame, path: str, source: str, out: list[T.StructField], kind: type, make,
          less: tuple[str, ...] = ()) -> DataFrame:
    """``df`` with more columns, made from column ``source`` by a codec in each worker, and without the columns ``less``."""
    vocabulary = df.sparkSession.sparkContext.broadcast(load_vocabulary(path))
    kept, made_names = common.without(df, *less, *[f.name for f in out]), [f.name for f in out]
    names = kept.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(kind, path, vocabulary)
        for batch in batches:
            for i in range(0, batch.num_rows, 1000):
                part = batch.slice(i, 1000)
                yield pa.RecordBatch.from_arrays([part.column("row"), *make(codec, part.column("source"))], ["row", *made_names])

    # The other columns travel as one struct, so no name of theirs can clash.
    rows = df.select(F.struct(*[F.col(f"`{n}`") for n in names], F.lit(0).alias("__")).alias("row"), F.col(f"`{source}`").alias("source"))
    done = rows.mapInArrow(run, T.StructType([rows.schema["row"], *out]))
    return done.select(*[F.col("row").getField(n).alias(n) for n in names], *made_names)


def _encode_column(codec: Codec, texts: pa.Array) -> pa.Array:
    ids, until = codec.encode_all(texts)
    return pa.ListArray.from_arrays(until.astype(np.int32), pa.array(ids))


def _decode_column(codec: Decoder, ids: pa.Array) -> pa.Array:
    flat, offsets = ids.values.to_numpy(zero_copy_only=False), ids.offsets.to_numpy()
    return pa.array([codec.decode(flat[a:b]) for a, b in zip(offsets[:-1], offsets[1:])], pa.string())


def encode(df: DataFrame, path: str, text_col: str = "text", out: str = "ids") -> DataFrame:
    """``df`` with the token ids of a text as array<int>.

    The ids are those of the file's tokenizer without added special tokens; special tokens spelled out in the text
    become their own ids.  A null or empty text gives an empty array; long texts are encoded whole, in time that grows with
    their length; repeated rows are coded each, an empty table gives an empty result.  A column of the new name is replaced.
    """
    return _over(df.withColumn(text_col, F.col(f"`{text_col}`").cast("string")), path, text_col,
                 [T.StructField(out, T.ArrayType(T.IntegerType()))], Codec, lambda codec, texts: [_encode_column(codec, texts)])


def decode(df: DataFrame, path: str, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` with the text that token ids stand for, special tokens included; null or no ids give an empty text."""
    ids = F.coalesce(F.col(f"`{ids_col}`"), F.array().cast("array<int>"))
    return _over(df.withColumn(ids_col, ids), path, ids_col, [T.StructField(out, T.StringType())], Decoder,
                 lambda codec, ids_: [_decode_column(codec, ids_)])


def encode_and_decode(df: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """``df`` with ``ids`` and with ``decoded``, the text that the ids stand for, in place of the text, in one visit to a worker.

    Cases as in ``encode``.
    """
    def both(codec: Codec, texts: pa.Array) -> list[pa.Array]:
        ids = _encode_column(codec, texts)
        return [ids, _decode_column(codec, ids)]

    return _over(df.withColumn(text_col, F.col(f"`{text_col}`").cast("string")), path, text_col,
                 [T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())], Codec, both, (text_col,))


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def digests(coded: DataFrame) -> list:
    return [F.size("ids").cast("long").alias("n_tokens"),
            F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
            F.sha2("decoded", 256).alias("decoded_sha256")]


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = default_path()
    coded = encode_and_decode(common.table(spark, sf_dir, "documents").select("doc_id", "text"), path)
    return coded.select("doc_id", *digests(coded))
