"""BPE encoding by a depth-first walk over the trie of distinct words.

A prefix's encoding is fixed by its last token alone: with that token t taken off, what is left is a shorter prefix, and the
token before t is the last token of that one. So a trie node needs one number, the last token of its prefix, found from
the nodes above it. Words that share a prefix share its nodes, and each node is worked out once. The trie isn't stored:
sorted words visit it depth first, and the nodes that two neighbours share are the first `common prefix` states of a stack.

Two adjacent tokens may stand in an encoding when no merge across their border comes before the merges that made them. The
tokens at the border over time are the right spine of the left token's merge tree and the left spine of the right one's.
"""

from __future__ import annotations

import hashlib
import json
import os.path
import re
import string
from array import array
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from veilframe.llm.common import blocks, fresh, release, text_of

#: Words whose encodings a worker keeps from one block to the next; beyond that it starts afresh.
CACHE_WORDS = 200_000
#: Token pairs whose verdict a worker keeps.
CACHE_PAIRS = 400_000
#: Separators by str.split() that the tokenizers' pattern \s doesn't know.
NOT_SPACE = "\x1c\x1d\x1e\x1f"
PUNCTUATION = frozenset(string.punctuation)


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies: itself, or the next free one from U+0100 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    free = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(free)) for b in range(256)]


class MergeTable:
    """Tokens, merge ranks and spines of a BPE vocabulary whose words end in a suffix."""

    def __init__(self, model: dict):
        self.end = model.get("end_of_word_suffix") or ""
        self.ids: dict[str, int] = model["vocab"]
        self.rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        self.made: dict[int, int] = {}
        for r, merge in enumerate(model["merges"]):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            left, right, whole = self.ids[a], self.ids[b], self.ids[a + b]
            self.rank[left, right] = r
            if whole in self.parts:
                raise ValueError(f"two merges make token {whole}")
            self.parts[whole], self.made[whole] = (left, right), r
        for whole, (a, b) in self.parts.items():
            if max(self.made.get(a, -1), self.made.get(b, -1)) >= self.made[whole]:
                raise ValueError(f"token {whole} is made before its parts")
        n = len(self.end)
        #: By spelling: tokens inside a word, and tokens at its end, without the suffix.
        self.inner = {s: i for s, i in self.ids.items() if not (n and s.endswith(self.end))}
        self.final = {s[:-n]: i for s, i in self.ids.items() if s.endswith(self.end)} if n else self.inner
        self.pairs: dict[int, bool] = {}
        self.whole: dict[int, bool] = {}
        self.spines: dict[int, tuple[list, list]] = {}
        self.inner = {s: i for s, i in self.inner.items() if self.reachable(i)}
        self.final = {s: i for s, i in self.final.items() if self.reachable(i)}
        self.longest = max(map(len, [*self.inner, *self.final]))

    def spine(self, token: int) -> tuple[list, list]:
        """(token, rank of the merge that ends its time at the border), from the whole token down: right side, left side."""
        if (found := self.spines.get(token)) is None:
            found = ([], [])
            for side, out in ((1, found[0]), (0, found[1])):
                t, until = token, 1 << 60
                while True:
                    out.append((t, until))
                    if t not in self.parts:
                        break
                    t, until = self.parts[t][side], self.made[t]
            self.spines[token] = found
        return found

    def together(self, left: int, right: int) -> bool:
        """Whether the two may stand side by side in an encoding."""
        key = left << 17 | right
        if (known := self.pairs.get(key)) is None:
            known, rank = True, self.rank
            for a, a_until in self.spine(left)[0]:
                for b, b_until in self.spine(right)[1]:
                    r = rank.get((a, b))
                    # At equal ranks the leftmost pair goes first: the left token's own merge, or else the border's.
                    if r is not None and r < a_until and r <= b_until:
                        known = False
                        break
                if not known:
                    break
            if len(self.pairs) >= CACHE_PAIRS:
                self.pairs.clear()
            self.pairs[key] = known
        return known

    def reachable(self, token: int) -> bool:
        """Whether its spelling is encoded as this token; merges of its parts' border may forbid it."""
        if (known := self.whole.get(token)) is None:
            known = True
            if token in self.parts:
                a, b = self.parts[token]
                r = self.made[token]
                known = self.reachable(a) and self.reachable(b)
                for x, x_until in self.spine(a)[0]:
                    for y, y_until in self.spine(b)[1]:
                        q = self.rank.get((x, y))
                        known = known and (q is None or q >= r or not (q < x_until and q <= y_until))
            self.whole[token] = known
        return known

    def encode_sorted(self, words: Iterable[str]) -> Iterator[list[int]]:
        """Token ids of each word; the words come sorted, spelled in byte letters, none empty."""
        inner, final, longest, together, known = self.inner.get, self.final.get, self.longest, self.together, self.pairs.get
        last: list[int] = [-1]  # last token of each prefix on the way down, by length
        steps: list[int] = [0]  # its spelling's length
        before = ""
        for word in words:
            n, depth = len(word), 0
            top = min(len(last) - 1, n - 1)
            if word[:top] == before[:top]:
                depth = top
            else:
                while depth < top and word[depth] == before[depth]:
                    depth += 1
            del last[depth + 1 :], steps[depth + 1 :]
            for d in range(depth + 1, n + 1):
                table = final if d == n else inner
                for start in range(d - 1, max(0, d - longest) - 1, -1):
                    t = table(word[start:d])
                    if t is None:
                        continue
                    if not start:
                        break
                    p = last[start]
                    if (ok := known(p << 17 | t)) is None:
                        ok = together(p, t)
                    if ok:
                        break
                else:
                    raise ValueError(f"no token ends the prefix {word[:d]!r}")
                last.append(t)
                steps.append(d - start)
            out, d = [], n
            while d:
                out.append(last[d])
                d -= steps[d]
            out.reverse()
            yield out
            # the state at the word's end is that of a final token; a longer word needs the inner one
            last.pop(), steps.pop()
            before = word


class TrieEncoder:
    """Encodes texts as the tokenizers library does, its merges replaced by the trie walk."""

    def __init__(self, path: str):
        spec = json.load(open(path, encoding="utf-8"))
        self.tok = Tokenizer.from_file(path)
        self.prepare(spec["model"])
        self.special = [(t["content"], t["id"]) for t in spec["added_tokens"]]
        self.spelled = {i: s for s, i in spec["model"]["vocab"].items()} | {i: s for s, i in self.special}
        self.ids: dict[str, bytes] = {}
        self.text: dict[str, str] = {}

    def prepare(self, model: dict) -> None:
        self.table = MergeTable(model)
        self.letters = byte_letters()
        self.high = {chr(b): self.letters[b] for b in range(256) if self.letters[b] != chr(b)}
        self.high = str.maketrans(self.high)

    def words(self, piece: str) -> list[str]:
        """The words, in byte letters, of a piece without white space."""
        low = piece.lower()
        if piece.isascii():
            if piece.isalpha():
                return [low]
            if piece[-1] in PUNCTUATION and piece[:-1].isalpha():
                return [low[:-1], low[-1]]
        elif max(piece) < "Ā":
            body = low[:-1] if low[-1] in ".,;:!?" else low
            if body.isalpha():
                word = body.encode().decode("latin-1").translate(self.high)
                return [word] if body is low else [word, low[-1]]
        return [w for w, _ in self.tok.pre_tokenizer.pre_tokenize_str(self.tok.normalizer.normalize_str(piece))]

    def learn(self, pieces: set[str]) -> None:
        """Encodes the pieces that aren't known yet, by one walk over the trie of their distinct words."""
        if len(self.ids) > CACHE_WORDS:  # what this block needs stays
            self.ids = {p: x for p, x in self.ids.items() if p in pieces}
            self.text = {p: x for p, x in self.text.items() if p in pieces}
        new = {p: self.words(p) for p in pieces if p not in self.ids}
        words = sorted({w for ws in new.values() for w in ws})
        spelled, coded = self.spelled, {}
        for w, ids in zip(words, self.table.encode_sorted(words), strict=True):
            coded[w] = (array("I", ids).tobytes(), " ".join([spelled[i] for i in ids]))
        for p, ws in new.items():
            self.ids[p] = b"".join([coded[w][0] for w in ws])
            self.text[p] = " ".join([coded[w][1] for w in ws])

    def forget(self) -> None:
        self.ids, self.text = {}, {}

    def pieces(self, text: str) -> list[str | int]:
        """Pieces between white space, and special tokens as their ids."""
        parts: list[str | int] = [text]
        for content, i in self.special:
            if content in text:
                parts = [x for p in parts for x in ([p] if isinstance(p, int) else [y for k, q in enumerate(p.split(content)) for y in ([i, q] if k else [q])])]
        out: list[str | int] = []
        for p in parts:
            if isinstance(p, int):
                out.append(p)
            elif NOT_SPACE[0] in p or NOT_SPACE[1] in p or NOT_SPACE[2] in p or NOT_SPACE[3] in p:
                out.append(p)  # the library splits it
            else:
                out += p.split()
        return out

    def encode(self, texts: list[str]) -> Iterator[tuple[bytes, str]]:
        """For each text its ids as little-endian unsigned 32-bit integers, and the decoded text."""
        cut = [self.pieces(t) for t in texts]
        pieces = set(chain.from_iterable(cut))
        self.learn(pieces.difference(i for _, i in self.special))
        for _, i in self.special:
            self.ids[i], self.text[i] = array("I", [i]).tobytes(), self.spelled[i]
        ids, text = self.ids.__getitem__, self.text.__getitem__
        for ps in cut:
            yield b"".join(map(ids, ps)), " ".join([s for s in map(text, ps) if s])


#: Words of a lower-case text whose characters are all below U+0100, as the vocabulary's pattern cuts it: contractions, runs
#: of letters, single digits, runs of others. Composition leaves such texts as they are.
LATIN_WORDS = re.compile("[a-zªµºß-öø-ÿ]+|'(?:s|t|re|ve|m|ll|d)|[0-9²³¹¼-¾]|[^a-zªµºß-öø-ÿ0-9²³¹¼-¾\t-\r\x85\xa0 ]+")
#: Words that a worker's cache holds, and words given to the library as one text.
LIBRARY_WORDS, TOGETHER = 400_000, 5_000


class LibraryEncoder(TrieEncoder):
    """The same ids by the library itself: distinct words, many to a text; a token with the vocabulary's suffix ends a word."""

    def prepare(self, model: dict) -> None:
        self.coded: dict[str | int, bytes] = {}
        self.often: set[str | int] = set()
        end, vocab = model.get("end_of_word_suffix"), model["vocab"]
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        if end:
            self.ends[[i for s, i in vocab.items() if s.endswith(end)]] = True

    def cut(self, text: str) -> list[str | int]:
        """A text's words in lower case, pieces that the library must cut, and special tokens as their ids."""
        if not any(content in text for content, _ in self.special):
            try:
                text.encode("latin-1")
                return LATIN_WORDS.findall(text.lower())
            except UnicodeEncodeError:
                pass
        out: list[str | int] = []
        for p in self.pieces(text):
            if isinstance(p, str) and max(p) < "Ā":
                out += LATIN_WORDS.findall(p.lower())
            else:
                out.append(p)
        return out

    def code(self, words: list[str]) -> None:
        """Encodes distinct words and pieces."""
        plain = [w for w in words if w.isascii() or max(w) < "Ā"]
        others = [w for w in words if not (w.isascii() or max(w) < "Ā")]
        for lo in range(0, len(plain), 4 * TOGETHER):
            parts = [plain[k : k + TOGETHER] for k in range(lo, min(lo + 4 * TOGETHER, len(plain)), TOGETHER)]
            for part, got in zip(parts, self.tok.encode_batch_fast([" ".join(x) for x in parts], add_special_tokens=False), strict=True):
                ids = np.array(got.ids, "<u4")
                last = (np.flatnonzero(self.ends[ids]) + 1) * 4
                if len(last) != len(part) or (len(last) and last[-1] != 4 * len(ids)):
                    others += part
                    continue
                data, at = ids.tobytes(), 0
                for w, end in zip(part, last.tolist(), strict=True):
                    self.coded[w] = data[at:end]
                    at = end
        for k in range(0, len(others), 50_000):
            part = others[k : k + 50_000]
            self.coded.update((w, array("I", e.ids).tobytes()) for w, e in zip(part, self.tok.encode_batch(part, add_special_tokens=False), strict=True))

    def forget(self) -> None:
        self.coded, self.often = {}, set()

    def encode_ids(self, texts: list[str]) -> Iterator[bytes]:
        """For each text its ids as little-endian unsigned 32-bit integers."""
        cut = [self.cut(t) for t in texts]
        words = set(chain.from_iterable(cut))
        new = words.difference(self.coded)
        self.often |= words - new
        if len(self.coded) + len(new) > LIBRARY_WORDS:  # words of several blocks stay, or else those of this one
            if 2 * len(self.often) > LIBRARY_WORDS:
                self.often = words - new
            self.coded = {w: self.coded[w] for w in self.often}
        self.code([w for w in new if isinstance(w, str)])
        self.coded |= {i: array("I", [i]).tobytes() for _, i in self.special}
        for ws in cut:
            yield b"".join(map(self.coded.__getitem__, ws))


#: One encoder for each path, kind and worker process.
_ENCODERS: dict[tuple[type, str], TrieEncoder] = {}


def encoder(path: str, kind: type = TrieEncoder) -> TrieEncoder:
    if (kind, path) not in _ENCODERS:
        if not os.path.exists(path):
            raise FileNotFoundError(f"no tokenizer file at {path}")
        _ENCODERS[kind, path] = kind(path)
    return _ENCODERS[kind, path]


def encode(df: DataFrame, tokenizer: str, text: str = "text", keep: list[str] | None = None, ids: str | None = "ids", decoded: str | None = "decoded", ids_sha256: str | None = None, decoded_sha256: str | None = None) -> DataFrame:
    """Adds each text's ids (BINARY, little-endian unsigned 32-bit), its decoded text, or their SHA-256 in hexadecimal, if named.

    keep: columns of df to return besides; all if None. A column of df named as an output is dropped. n_tokens is always
    added. Null text counts as empty and has no ids; its decoded text is empty. Equal rows stay as they are, one result each.
    Rows keep their order within a partition. Texts are handled in blocks of bounded size; no shuffle.
    """
    kinds = {ids: "binary", decoded: "string", ids_sha256: "string", decoded_sha256: "string"}
    outs = {"n_tokens": "long", **{c: k for c, k in kinds.items() if c}}
    cols = [c for c in (df.columns if keep is None else keep) if c.lower() not in [o.lower() for o in outs]]
    schema = df.select(*cols).schema
    for c, kind in outs.items():
        schema = schema.add(c, kind)
    own_text = fresh(df, "text")
    source = df.select(*cols, text_of(text).alias(own_text))
    sha = lambda x: hashlib.sha256(x).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(tokenizer)
        for table in blocks(batches, own_text, 4_000_000):
            got = list(own.encode(table.column(own_text).to_pylist()))
            data = {"n_tokens": pa.array([len(x) // 4 for x, _ in got], pa.int64())}
            if ids:
                data[ids] = pa.array([x for x, _ in got], pa.binary())
            if decoded:
                data[decoded] = pa.array([x for _, x in got], pa.string())
            if ids_sha256:
                data[ids_sha256] = pa.array([sha(x) for x, _ in got], pa.string())
            if decoded_sha256:
                data[decoded_sha256] = pa.array([sha(x.encode()) for _, x in got], pa.string())
            yield from pa.Table.from_arrays([*(table.column(c).combine_chunks() for c in cols), *(data[c] for c in outs)], names=[*cols, *outs]).to_batches(max_chunksize=500)
        own.forget()
        release()

    return source.mapInArrow(run, schema)


def digests(df: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of each document."""
    return encode(df, tokenizer, keep=["doc_id"], ids=None, decoded=None, ids_sha256="ids_sha256", decoded_sha256="decoded_sha256")
