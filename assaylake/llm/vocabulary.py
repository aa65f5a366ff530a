"""Word-level BPE vocabularies in the file format of the `tokenizers` library, and exact encoding of words.

Encoding walks a trie of the distinct words. BPE has the property that the encoding of a string is determined by the
last token of each of its prefixes: token t ends prefix i if t encodes to itself and no merge crosses the border between
t and the last token of the prefix before it. Words that share a prefix share its states, so they are computed once.
"""

from __future__ import annotations

import hashlib
import json
import re
from functools import lru_cache

NEVER = 1 << 60
#: Latin letters beyond ASCII that normalisation leaves alone and that have one lower-case letter each.
LATIN = "\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u0148\u014a-\u017e"
#: Pairs of neighbouring tokens whose border has been judged; emptied when full, which changes no result.
PAIR_MEMO = 1_000_000


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(printable)]
    out = [""] * 256
    for b in printable:
        out[b] = chr(b)
    for k, b in enumerate(rest):
        out[b] = chr(256 + k)
    return out


class Vocabulary:
    """Merges and tokens of one file; `encode_words` is the trie traversal, `pieces` what the library does before it."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, "rb") as f:
            raw = f.read()
        spec = json.loads(raw)
        model, self.library = spec["model"], Tokenizer.from_file(path)
        self.end = model.get("end_of_word_suffix") or ""
        if model["type"] != "BPE" or model.get("dropout") or model.get("continuing_subword_prefix") or not self.end:
            raise ValueError(f"{path}: only BPE vocabularies with an end-of-word suffix are read")
        self.ids: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.split_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.text: dict[int, str] = {i: s for s, i in self.ids.items()} | {i: s for s, i in self.special.items()}
        self.symbol = byte_symbols()
        self.ascii_pieces = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^ \t-\ra-z0-9]+")
        self.latin = re.compile(f"[!-~{LATIN}]+")
        self.latin_pieces = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[a-z{LATIN}]+|[0-9]|[^ \t-\ra-z0-9{LATIN}]+")
        self.latin_symbols = {c: "".join(self.symbol[b] for b in chr(c).encode()) for c in range(0xC0, 0x180)}
        self._build(model["merges"])

    def _build(self, merges: list) -> None:
        plain = {s: self.ids[s] for s in self.symbol}
        final = {s: self.ids[s + self.end] for s in self.symbol}
        self.parts: dict[int, tuple[int, int]] = {}
        self.born = dict.fromkeys([*plain.values(), *final.values()], -1)
        self.rank: dict[int, int] = {}
        finals = set(final.values())
        for r, pair in enumerate(merges):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            x, y, made = self.ids[a], self.ids[b], self.ids[a + b]
            if made in self.parts or max(self.born.get(x, NEVER), self.born.get(y, NEVER)) >= r:
                raise ValueError("a token has two merges, or a merge comes before its parts")
            self.parts[made], self.born[made], self.rank[x << 20 | y] = (x, y), r, r
            if y in finals:
                finals.add(made)
                final[(a + b)[: -len(self.end)]] = made
            else:
                plain[a + b] = made
        self._sound: dict[int, bool] = dict.fromkeys((i for i, r in self.born.items() if r < 0), True)
        self._pairs: dict[int, bool] = {}
        self.plain = {s: i for s, i in plain.items() if self._encodes_itself(i)}
        self.final = {s: i for s, i in final.items() if self._encodes_itself(i)}
        self.starts = {s[:k] for s in [*self.plain, *self.final] for k in range(1, len(s) + 1)}
        self.length = {i: len(s) for s, i in [*self.plain.items(), *self.final.items()]}

    def _spine(self, token: int, side: int, until: int) -> list[tuple[int, int]]:
        """What stands at one edge of the token over time: (token, merge that ends it)."""
        out = [(token, until)]
        while (p := self.parts.get(token)) is not None:
            until, token = self.born[token], p[side]
            out.append((token, until))
        return out

    def _kept(self, a: int, b: int, until: int) -> bool:
        """No merge crosses the border between a and b before merge `until`. Of equal merges the left one goes first."""
        right = self._spine(b, 0, until)
        for x, gone in self._spine(a, 1, until):
            for y, gone_too in right:
                r = self.rank.get(x << 20 | y, NEVER)
                if r < gone and r <= gone_too and r < until:
                    return False
        return True

    def _encodes_itself(self, token: int) -> bool:
        if token not in self._sound:
            a, b = self.parts[token]
            self._sound[token] = (
                self._encodes_itself(a) and self._encodes_itself(b) and self._kept(a, b, self.born[token])
            )
        return self._sound[token]

    def _fits(self, a: int, b: int) -> bool:
        key = a << 20 | b
        known = self._pairs.get(key)
        if known is None:
            if len(self._pairs) >= PAIR_MEMO:
                self._pairs.clear()
            known = self._pairs[key] = self._kept(a, b, NEVER)
        return known

    def encode_words(self, words: set[str]) -> dict[str, list[int]]:
        """Encodings of words in byte symbols. Sorted words are the trie's leaves in depth-first order; the two lists
        hold the states on the path from its root to the current leaf."""
        out: dict[str, list[int]] = {}
        plain, final, starts, length, pairs = self.plain, self.final, self.starts, self.length, self._pairs
        last, match, previous = [0], [0], ""
        for word in sorted(words):
            n = len(word)
            shared, most = 0, min(len(previous), n) - 1
            while shared < most and previous[shared] == word[shared]:
                shared += 1
            del last[shared + 1 :], match[shared + 1 :]
            for i in range(shared + 1, n + 1):
                m = match[i - 1] + 1
                while word[i - m : i] not in starts:
                    m -= 1
                tokens = plain if i < n else final
                for k in range(m, 0, -1):
                    t = tokens.get(word[i - k : i])
                    if t is None:
                        continue
                    if k == i:
                        break
                    before = last[i - k]
                    known = pairs.get(before << 20 | t)
                    if known or known is None and self._fits(before, t):
                        break
                match.append(m)
                last.append(t)
            ids, i = [], n
            while i:
                t = last[i]
                ids.append(t)
                i -= length[t]
            ids.reverse()
            out[word] = ids
            previous = word
            # the state of the whole word belongs to its end symbol; longer words need that of the plain prefix
            del last[n:], match[n:]
        return out

    def pieces(self, chunk: str) -> list[str | int]:
        """A chunk without white space as the words, in byte symbols, and special ids that the library makes of it."""
        if chunk.isascii():
            if chunk.isalpha():
                return [chunk.lower()]
            if "<|" not in chunk:
                words = self.ascii_pieces.findall(chunk.lower())
                if chunk.isprintable():
                    return words
                return ["".join(self.symbol[ord(c)] for c in w) for w in words]
        elif "<|" not in chunk and self.latin.fullmatch(chunk):
            lower = chunk.lower()
            if chunk.isalpha():
                return [lower.translate(self.latin_symbols)]
            return [w.translate(self.latin_symbols) for w in self.latin_pieces.findall(lower)]
        out: list[str | int] = []
        for part in self.split_special.split(chunk) if self.split_special else [chunk]:
            if part in self.special:
                out.append(self.special[part])
            elif part:
                text = self.library.normalizer.normalize_str(part)
                out += [w for w, _ in self.library.pre_tokenizer.pre_tokenize_str(text)]
        return out

    def tokenize_words(self, words: set[str]) -> dict[str, list[int]]:
        """Encodings of words in byte symbols by the library's own merges."""
        tokenize = self.library.model.tokenize
        return {w: [t.id for t in tokenize(w)] for w in words}

    def encode_chunks(self, chunks: list[str], known: dict[str, list[int]] | None = None, trie: bool = False) -> list:
        """Ids of each chunk, to be read only: chunks of one word share its list. known: encodings from before, by word, to which
        the new ones are added."""
        known = {} if known is None else known
        cut = [c.lower() if c.isascii() and c.isalpha() else self.pieces(c) for c in chunks]
        words = {c for c in cut if type(c) is str}
        words.update(p for c in cut if type(c) is list for p in c if type(p) is str)
        words -= known.keys()
        known |= self.encode_words(words) if trie else self.tokenize_words(words)
        out = []
        for c in cut:
            if type(c) is str:
                out.append(known[c])
                continue
            if len(c) == 1 and type(c[0]) is str:
                out.append(known[c[0]])
                continue
            ids: list[int] = []
            for p in c:
                if type(p) is str:
                    ids += known[p]
                else:
                    ids.append(p)
            out.append(ids)
        return out

    def cut_chunks(self, chunks: list[str]) -> list[list[str | int]]:
        """`pieces` of each chunk."""
        pieces = self.pieces
        return [[c.lower()] if c.isascii() and c.isalpha() else pieces(c) for c in chunks]

    def encode_pieces(self, pieces: list[str | int], trie: bool = False) -> list[list[int]]:
        """Ids of each piece: those of a word, or the special id that it is."""
        if trie:
            coded = self.encode_words({p for p in pieces if type(p) is str})
            return [coded[p] if type(p) is str else [p] for p in pieces]
        tokenize = self.library.model.tokenize
        return [[t.id for t in tokenize(p)] if type(p) is str else [p] for p in pieces]

    def token_bytes(self) -> list[bytes]:
        """UTF-8 of every token's own text, by id."""
        return [self.text.get(i, "").encode() for i in range(max(self.text) + 1)]


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    """Read once per Python worker."""
    return Vocabulary(path)


def version(path: str) -> str:
    """Digest of a vocabulary file, by which stored results name it."""
    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()
