"""BPE encoding and decoding by prefix-sharing trie traversal.

Words (pre-tokens) recur, and distinct words share prefixes. A worker puts the distinct words of a batch into
a trie over symbols and walks it depth first. The state of a trie node is the last token of the encoding of the
prefix that the node spells, with the node at which this token begins; the rest of the encoding is the state
of that earlier node. So each shared prefix is encoded once, and a word costs one step per new node.

The last token of a prefix is the token that ends there and may follow the last token of the prefix before it: two
neighbours may stand side by side if no merge crosses their border while both are being merged, nor afterwards.

Results for edge cases: a null text counts as empty; an empty text has no ids, and both digests are those of the
empty string. A text of any length is encoded whole, word by word. Rows are independent, so repeated rows give repeated results; an
empty table gives an empty one. Other columns, whatever their names, are ignored. A tokenizer file whose rules of normalising, splitting and
decoding aren't RULES is an error, since its ids would be wrong.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from math import inf

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from tokenizers import Tokenizer

from talkweave.llm.common import bounded_batches, table

#: Distinct words that a worker remembers before it starts anew.
WORDS_KEPT = 300_000
PAIRS_KEPT = 2_000_000
#: The same words as the vocabulary's pattern in texts of ASCII, and of Latin letters.
ASCII_WORDS = re.compile(r"[a-z]+|[0-9]|'s|'t|'re|'ve|'m|'ll|'d|[^\sa-z0-9]+", re.ASCII)
LATIN_WORDS = re.compile(r"[a-zß-öø-ÿœ]+|[0-9]|'s|'t|'re|'ve|'m|'ll|'d|[^\sa-z0-9ß-öø-ÿœ]+")
#: Beyond letters of Latin-1 with œ, common punctuation and the euro sign; some signs of Latin-1 count as letters or numbers.
BEYOND_LATIN = re.compile(r"[^\n\t -~¡-©«-±´¶-¸»¿-Ýß-ÿœ–—‘-‟†-…€]|[\x7f-\xa0]")
# The rules that a tokenizer file must have: one character's case at a time, words of letters, single digits, other signs; no decoder.
RULES = {
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
    "decoder": None,
}
SPACES = regex.compile(r"\p{White_Space}+")


def _later() -> re.Pattern:
    """Characters that Unicode got after version 3.2: whether they are letters, and their lower case, differs between
    libraries, so texts with them take the tokenizer library's own splitting."""
    old = unicodedata.ucd_3_2_0.category
    spans, begin = [], None
    for c in [*range(0x10000), 0x110000]:
        new = c < 0x10000 and not 0xD800 <= c < 0xE000 and old(chr(c)) == "Cn"
        if new and begin is None:
            begin = c
        elif not new and begin is not None:
            spans.append(f"\\u{begin:04x}-\\u{c - 1 if c < 0x10000 else 0xFFFF:04x}")
            begin = None
    return re.compile("[" + "".join(spans) + "\U00010000-\U0010ffff]")


LATER = _later()


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def read_tokenizer(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def _byte_symbols() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies: printable Latin-1 stands for itself, the
    other bytes for code points from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b if b in plain else next(spare)) for b in range(256)]


class WordEncoder:
    """Turns words into ids; remembers at most WORDS_KEPT of them."""

    def __init__(self, source: bytes):
        spec = json.loads(source)
        model = spec["model"]
        if other := [k for k, rule in RULES.items() if spec.get(k) != rule]:
            raise ValueError(f"the tokenizer file has other rules than expected: {', '.join(other)}")
        if model["type"] != "BPE" or any(not t["content"].startswith("<|") for t in spec["added_tokens"]):
            raise ValueError("the tokenizer file has another kind of model, or special tokens that don't begin with <|")
        self.end = model.get("end_of_word_suffix") or ""
        self.vocab: dict[str, int] = model["vocab"]
        self.names = {i: t for t, i in self.vocab.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names |= {i: t for t, i in self.special.items()}
        self.special_at = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.word_at = regex.compile(next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"))
        self.bytes = _byte_symbols()
        self.library = Tokenizer.from_str(source.decode())
        self.merges = [m if isinstance(m, list) else m.split(" ", 1) for m in model["merges"]]
        self.ids: dict[str, tuple[int, ...]] = {}

    def build(self) -> None:
        """What the trie walk needs."""
        merges = self.merges
        self.ranks = {(self.vocab[a], self.vocab[b]): r for r, (a, b) in enumerate(merges)}
        #: what a token is merged from, and when
        self.halves = {self.vocab[a + b]: (self.vocab[a], self.vocab[b], r) for r, (a, b) in reversed([*enumerate(merges)])}
        self.edges: dict[tuple[int, int], tuple[tuple[int, ...], tuple[float, ...]]] = {}
        self.fits: dict[tuple[int, int], bool] = {}
        #: tokens inside a word, and at its end without the suffix, by what they spell; only those that merging reaches
        reached = [i for i in self.vocab.values() if self._reached(i)]
        name = self.names
        self.inner = {name[i]: i for i in reached if not (self.end and name[i].endswith(self.end))}
        self.final = {name[i][: len(name[i]) - len(self.end)]: i for i in reached if name[i].endswith(self.end)}
        self.longest = max(map(len, [*self.inner, *self.final]), default=1)

    def _edge(self, token: int, side: int) -> tuple[tuple[int, ...], tuple[float, ...]]:
        """The pieces that stand at the left (0) or right (1) edge of a token while it is merged, and the rank at
        which each goes into the next."""
        if (known := self.edges.get((token, side))) is None:
            half = self.halves.get(token)
            if half is None:
                known = (token,), (inf,)
            else:
                pieces, ends = self._edge(half[side], side)
                known = (*pieces, token), (*ends[:-1], half[2], inf)
            self.edges[token, side] = known
        return known

    def _apart(self, left: int, right: int, whole: bool) -> bool:
        """Whether no merge crosses the border of two tokens while both are made; whole: when they are ready either.
        Among merges of one rank the leftmost goes first."""
        xs, x_ends = self._edge(left, 1)
        ys, y_ends = self._edge(right, 0)
        i = j = 0
        while True:
            rank, dx, dy = self.ranks.get((xs[i], ys[j]), inf), x_ends[i], y_ends[j]
            if dx == inf and dy == inf:
                return not whole or rank == inf
            if rank < dx and rank <= dy:
                return False
            if dx <= dy:
                i += 1
            else:
                j += 1

    def _reached(self, token: int) -> bool:
        half = self.halves.get(token)
        return half is None or self._reached(half[0]) and self._reached(half[1]) and self._apart(half[0], half[1], False)

    def may_follow(self, left: int, right: int) -> bool:
        if (known := self.fits.get((left, right))) is None:
            if len(self.fits) > PAIRS_KEPT:
                self.fits.clear()
            known = self.fits[left, right] = self._apart(left, right, True)
        return known

    def learn(self, words: set[str]) -> None:
        """Encodes words that are not known yet. In sorted order they are the depth-first walk of their trie: the path
        to the node where two neighbours part is kept, and only nodes below it are new."""
        symbols = self.bytes
        spelled = sorted(("".join([symbols[b] for b in w.encode("utf-8", "surrogatepass")]) if not w.isascii() or not w.isprintable() else w, w) for w in words)
        tokens, starts = [-1], [0]  # of the prefix of each length: its last token and where this begins
        before = ""
        for spelling, word in spelled:
            n = len(spelling)
            keep, most = 0, min(n - 1, len(tokens) - 1)
            while keep < most and spelling[keep] == before[keep]:
                keep += 1
            del tokens[keep + 1 :], starts[keep + 1 :]
            for depth in range(keep + 1, n):
                self._step(self.inner, spelling, depth, tokens, starts)
            self._step(self.final if self.end else self.inner, spelling, n, tokens, starts)
            ids, at = [], n
            while at:
                ids.append(tokens[at])
                at = starts[at]
            ids.reverse()
            self.ids[word] = tuple(ids)
            if self.end:
                tokens.pop()
                starts.pop()
            before = spelling

    def _step(self, known: dict[str, int], spelling: str, depth: int, tokens: list[int], starts: list[int]) -> None:
        fits = self.fits
        for start in range(max(0, depth - self.longest), depth):
            token = known.get(spelling[start:depth])
            if token is not None and (not start or (fits.get((tokens[start], token)) or self.may_follow(tokens[start], token))):
                tokens.append(token)
                starts.append(start)
                return
        raise ValueError(f"the vocabulary can't spell {spelling!r}")

    def words(self, text: str) -> list[str]:
        """The words of a text, normalised; special tokens as they stand."""
        if text.isascii() and (self.special_at is None or "<|" not in text):
            return ASCII_WORDS.findall(text.lower())
        out: list[str] = []
        for piece in self.special_at.split(text) if self.special_at is not None else [text]:
            if piece in self.special:
                out.append(piece)
            elif LATER.search(piece):
                plain = self.library.normalizer.normalize_str(piece)
                out += [plain[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(plain)]
            elif piece:
                # each character is lowered by itself: a capital sigma never takes its final form
                plain = SPACES.sub(" ", unicodedata.normalize("NFC", piece)).replace("Σ", "σ").lower()
                out += LATIN_WORDS.findall(plain) if not BEYOND_LATIN.search(plain) else self.word_at.findall(plain)
        return out

    def ensure(self, words: list[str]) -> None:
        new = set(words).difference(self.ids)
        if not new:
            return
        if len(self.ids) > WORDS_KEPT:
            self.ids.clear()
            self.on_clear()
            new = set(words)
        for s in new & self.special.keys():
            self.ids[s] = (self.special[s],)
        self.learn(new - self.special.keys())
        for w in new:
            self.on_word(w, self.ids[w])

    def on_clear(self) -> None: ...

    def on_word(self, word: str, ids: tuple[int, ...]) -> None: ...


class TextEncoder(WordEncoder):
    """Also keeps each word's ids as text, and decoded."""

    def __init__(self, source: bytes):
        super().__init__(source)
        self.build()
        self.on_clear()

    def on_clear(self) -> None:
        self.as_text: dict[str, str] = {}
        self.as_tokens: dict[str, str] = {}

    def on_word(self, word: str, ids: tuple[int, ...]) -> None:
        self.as_text[word] = " ".join(map(str, ids))
        self.as_tokens[word] = " ".join(self.names[i] for i in ids)

    def known(self, text: str | None) -> list[str]:
        words = self.words(text or "")
        self.ensure(words)
        return words

    def digests(self, text: str | None) -> tuple[int, str, str]:
        words = self.known(text)
        ids = " ".join(map(self.as_text.__getitem__, words))
        decoded = " ".join(map(self.as_tokens.__getitem__, words))
        return ids.count(" ") + 1 if ids else 0, hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()

    def encode(self, text: str | None) -> list[int]:
        words = self.known(text)
        return [i for w in words for i in self.ids[w]]

    def decode(self, ids: list[int]) -> str:
        """The vocabulary has no decoder, so tokens are joined by spaces; unknown ids are left out."""
        return " ".join(self.names[i] for i in ids if i in self.names)


class PackedEncoder(WordEncoder):
    """Texts to packed ids only: the library's model encodes each distinct word. Of too many words, those met first are kept,
    since common words are met early."""

    def __init__(self, source: bytes):
        super().__init__(source)
        self.known = {w: i.to_bytes(4, "little") for w, i in self.special.items()}

    def packed(self, text: str | None) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        words, known = self.words(text or ""), self.known
        try:
            return b"".join([known[w] for w in words])
        except KeyError:
            model, symbols = self.library.model, self.bytes
            for w in set(words).difference(known):
                spelled = w if w.isascii() and w.isprintable() else "".join([symbols[b] for b in w.encode("utf-8", "surrogatepass")])
                known[w] = b"".join([t.id.to_bytes(4, "little") for t in model.tokenize(spelled)])
        out = b"".join([known[w] for w in words])
        if len(known) > 2 * WORDS_KEPT:
            for w in [*known][WORDS_KEPT:]:
                del known[w]
        return out


@lru_cache(maxsize=1)
def packed_encoder(source: bytes) -> PackedEncoder:
    return PackedEncoder(source)


@lru_cache(maxsize=2)
def encoder(source: bytes) -> TextEncoder:
    """One encoder per worker, whose words outlive a task."""
    return TextEncoder(source)


def encode_documents(df: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids array<int>, decoded string) for every row."""
    bounded_batches(df.sparkSession)
    source = df.sparkSession.sparkContext.broadcast(read_tokenizer(path or tokenizer_path()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(source.value)
        for b in batches:
            ids = [enc.encode(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(ids, pa.list_(pa.int32())), pa.array([enc.decode(i) for i in ids], pa.string())], ["id", "ids", "decoded"]
            )

    kind = df.select(id_col).schema[0].dataType.simpleString()
    return df.select(id_col, text_col).mapInArrow(run, f"id {kind}, ids array<int>, decoded string").withColumnRenamed("id", id_col)


def encoding_digests(df: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) for every row."""
    bounded_batches(df.sparkSession)
    source = df.sparkSession.sparkContext.broadcast(read_tokenizer(path or tokenizer_path()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(source.value)
        for b in batches:
            rows = [enc.digests(t) for t in b.column(1).to_pylist()]
            n, ids, decoded = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())],
                ["id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    kind = df.select(id_col).schema[0].dataType.simpleString()
    return df.select(id_col, text_col).mapInArrow(run, f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string").withColumnRenamed("id", id_col)


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoding_digests(table(spark, sf_dir, "documents"))
