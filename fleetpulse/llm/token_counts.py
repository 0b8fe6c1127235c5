"""Token counts by the whole-token shortcut (operator 3).

A byte-level BPE vocabulary is searched once, offline: a vocabulary string
is *proven* when the library itself encodes it alone to exactly that one
token.  Merges never cross a pre-token, so a proven string counts 1 wherever
it stands as a pre-token.  Texts are cut into pre-tokens, proven ones are
counted by dictionary look-up, and only the rest go through the library's
merges.

No pre-token of the pattern reaches over a single space between two
characters that are not white space: the space belongs to what follows, and
the pattern looks no further than one character ahead.  So a text is first
split at such spaces, and the counts of the pieces between them (mostly words
with their punctuation) are remembered, in two generations of at most
``CACHE_LIMIT`` pieces per worker; only pieces not seen lately are cut into
pre-tokens at all.

The cut follows the library's own idea of letters, digits, white space and
other signs, found offline too, character by character: the library is asked
whether it joins the character to a letter, a digit or a sign.  A text with a
character beyond those planes goes to the library whole.

Defined cases: a null or empty text has 0 bytes and 0 tokens; special strings
inside a text count as one special token each (the library's default); null
or repeated ids are kept as they are, one result row per input row; texts of
any length are counted whole; other columns are not read.
"""

from __future__ import annotations

import itertools
import json
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from .common import BOOL, LONG, field, map_arrow

#: The byte-level pre-token pattern (fixed value of the public format): L letters, N digits, S white space.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?[{L}]+| ?[{N}]+| ?[^{S}{L}{N}]+|[{S}]+(?![^{S}])|[{S}]+"
CACHE_LIMIT = 300_000
#: Code points whose class is asked (the planes with assigned letters and signs).
ASK_UP_TO = 0x32000
LATIN = 0x250
# Python's white space is a superset of the pattern's.
OTHER_SPACE = re.compile(r"[^\S \n]").search
EVEN_SPLIT = re.compile(r"(?<=\S) (?=\S)").split


def load(path: str):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


def supported(spec: dict) -> bool:
    """The shortcut holds for byte-level BPE without normalizer, prefix space or dropout."""
    pre, model = spec.get("pre_tokenizer") or {}, spec.get("model") or {}
    return (model.get("type") == "BPE" and pre.get("type") == "ByteLevel"
            and pre.get("use_regex", True) and not pre.get("add_prefix_space")
            and not spec.get("normalizer") and not model.get("dropout")
            and not any(t.get("lstrip") or t.get("rstrip") or t.get("single_word")
                        for t in spec.get("added_tokens", [])))


def prove(path: str) -> frozenset[str]:
    """Vocabulary strings that the library encodes alone as exactly that token."""
    t = load(path)
    strings = {}
    for token, i in t.get_vocab(with_added_tokens=False).items():
        s = t.decode([i], skip_special_tokens=False)
        if s and "�" not in s:
            strings[s] = i
    names = list(strings)
    alone = t.encode_batch(names, add_special_tokens=False)
    pieces = t.pre_tokenizer
    return frozenset(s for s, e in zip(names, alone, strict=True)
                     if e.ids == [strings[s]] and len(pieces.pre_tokenize_str(s)) == 1)


def classes(path: str, below: int = ASK_UP_TO) -> dict[str, str]:
    """L, N, S: the library's letters, digits and white space, as the inside of a pattern's brackets."""
    split = load(path).pre_tokenizer.pre_tokenize_str
    found: dict[str, list[int]] = {"L": [], "N": [], "": [], "S": []}
    for i in range(below):
        if not 0xD800 <= i < 0xE000:
            c = chr(i)
            found[next((k for k, before in zip(("L", "N", ""), "a1!") if len(split(before + c)) == 1), "S")].append(i)

    def inside(of: list[int]) -> str:
        cut = [0, *(k for k in range(1, len(of)) if of[k] != of[k - 1] + 1), len(of)]
        return "".join(f"\\U{of[i]:08x}-\\U{of[j - 1]:08x}" for i, j in zip(cut, cut[1:]) if i < j)

    return {k: inside(v) for k, v in found.items() if k}


def byte_letters() -> dict[int, str]:
    """The public byte-level alphabet: printable bytes as themselves, the others from U+0100 on."""
    same = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(same)]
    return {**{b: chr(b) for b in same}, **{b: chr(256 + k) for k, b in enumerate(rest)}}


class Counter:
    """Counts tokens of texts in one worker."""

    def __init__(self, path: str, proven: frozenset[str], kinds: dict[str, str], latin: dict[str, str]):
        spec = json.loads(open(path, encoding="utf-8").read())
        self.library = load(path)
        self.merges = self.library.model.tokenize
        self.letters = byte_letters()
        self.shortcut = supported(spec)
        # The full classes have hundreds of ranges; Latin pieces get the few they need.
        self.find_any = re.compile(PRE_TOKEN.format(**kinds)).findall
        self.find_latin = re.compile(PRE_TOKEN.format(**latin)).findall
        self.not_latin = re.compile(rf"[^\0-\U{LATIN - 1:08x}]").search
        self.word = re.compile(rf"([{latin['L']}]+)(?![^\0-\U{LATIN - 1:08x}])"
                               rf"(?:[^{latin['S']}{latin['L']}{latin['N']}\U{LATIN:08x}-\U0010ffff])*").fullmatch
        self.beyond = re.compile(rf"[\ud800-\udfff\U{ASK_UP_TO:08x}-\U0010ffff]").search
        special = [t["content"] for t in spec.get("added_tokens", [])]
        self.special = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True)))) \
            if special else None
        self.proven = proven
        self.signs: dict[str, int] = {}
        self.young: dict[str, int] = {}
        self.old: dict[str, int] = {}

    def merged(self, piece: str) -> int:
        return 1 if piece in self.proven else len(
            self.merges("\u0120" + piece[1:] if piece[0] == " " and piece.isascii() and piece[1:].isalnum()
                        else piece.encode().decode("latin-1").translate(self.letters)))

    def cut(self, piece: str) -> int:
        """Tokens of a piece: proven pre-tokens count 1, the rest are merged."""
        return sum(map(self.merged, (self.find_any if self.not_latin(piece) else self.find_latin)(piece)))

    def cut_word(self, piece: str) -> int:
        """The same for a piece that follows a space; a word and the signs after it need no search."""
        m = self.word(piece)
        if m is None:
            return self.cut(" " + piece)
        end = m.end(1)
        n = self.merged(" " + m.group(1))
        if end < len(piece):
            signs = piece[end:]
            if signs not in self.signs:
                if len(self.signs) > CACHE_LIMIT:
                    self.signs.clear()
                self.signs[signs] = self.cut(signs)
            n += self.signs[signs]
        return n

    def count(self, texts: list[str | None]) -> list[int]:
        """Tokens of each text; the texts' distinct pieces are looked up once."""
        totals, even, owners = np.zeros(len(texts), np.int64), [], []
        for i, text in enumerate(texts):
            if not text:
                continue
            if not self.shortcut or self.beyond(text):
                totals[i] = len(self.library.encode(text, add_special_tokens=False).ids)
                continue
            parts = self.special.split(text) if self.special is not None and self.special.search(text) else [text]
            totals[i] = len(parts) - 1
            for part in filter(None, parts):
                if ("  " in part or "\n " in part or " \n" in part or part[0] == " " or part[-1] == " "
                        or OTHER_SPACE(part)):
                    head, *rest = EVEN_SPLIT(part)
                    totals[i] += self.cut(head) + int(self.look_up(rest).sum())
                else:
                    totals[i] += self.cut(part.partition(" ")[0])
                    even.append(part)
                    owners.append(i)
        if even:
            split = pc.split_pattern(pa.array(even, pa.large_string()), " ")
            pieces = split.flatten().dictionary_encode()
            each = self.look_up(pieces.dictionary.to_pylist())[np.asarray(pieces.indices)]
            starts = np.asarray(split.offsets)[:-1]
            np.add.at(totals, owners, np.add.reduceat(each, starts) - each[starts])
        return totals.tolist()

    def look_up(self, names: list[str]) -> np.ndarray:
        """Tokens of distinct pieces that follow a space."""
        if len(self.young) > CACHE_LIMIT:
            self.old, self.young = self.young, {}
        young, old, out = self.young, self.old, []
        for p in names:
            n = young.get(p)
            if n is None:
                n = old.get(p)
                if n is None:
                    n = self.cut_word(p)
                young[p] = n
            out.append(n)
        return np.array(out, np.int64)


_counters: dict = {}


def token_counts(spark: SparkSession, df: DataFrame, tokenizer_path: str, max_tokens: int = 512,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit per row of ``df``; no shuffle.

    ``tokenizer_path`` is a tokenizers ``.json`` that every executor can open.
    The proven strings and the characters' classes are broadcast: at most the
    vocabulary and the character planes, fixed sizes.
    """
    known = spark.sparkContext.broadcast((
        prove(tokenizer_path), classes(tokenizer_path), classes(tokenizer_path, LATIN)))

    def run(batches):
        counter = _counters.get(tokenizer_path)
        if counter is None:
            counter = _counters[tokenizer_path] = Counter(tokenizer_path, *known.value)
        for b in batches:
            texts = b.column(1)
            n = pa.array(counter.count(texts.to_pylist()), pa.int64())
            size = pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64())
            yield [b.column(0), size, n, pc.greater(n, max_tokens)]

    return map_arrow(df, [id_col, text_col],
                     [field("doc_id", df.schema[id_col].dataType), field("n_bytes", LONG),
                      field("n_tokens", LONG), field("over_limit", BOOL)], run)
