"""BPE encoding and decoding by speculation: longest matches are proposed, adjacent pairs verified, only failing words merged.

Byte-pair encoding of a word is a sequence of tokens of which every adjacent pair, encoded alone, gives that pair again; and any
such sequence is the word's encoding: the first merge across a boundary would also be made in the pair alone. So a
sequence found in any way can be proven by its pairs. Merges run in the order of their ranks, which makes a pair's test a
table look-up: the tokens at the right edge of the left token, and those at the left edge of the right one, each live from
the rank that makes them to the rank that consumes them; the pair holds unless a rule joins two that live together.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

#: Chunks of text, and words, of a worker's newer memory; a full one replaces the older one, from which what is used again is taken.
REMEMBERED = 200_000
#: New chunks that are worked off together.
TOGETHER = 8000
#: Failing words up to so many symbols are merged side by side, longer ones each with a heap.
SHORT = 64
NEVER = np.int64(1) << 40
_ODD_SPACE = re.compile(r"[^\S\x20\x09-\x0D]")


# A common way of making words, and what it comes to for printable ASCII in lower case.
USUAL_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
USUAL_NORMAL = ["NFC", "Replace", "Lowercase"]
_ASCII_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+|\n")


class Memory:
    """A mapping that holds between ``REMEMBERED`` and twice as many of the keys asked for last."""

    def __init__(self) -> None:
        self.new: dict = {}
        self.old: dict = {}

    def unknown(self, keys: set) -> list:
        """The keys that are not remembered; the others are in ``new`` afterwards."""
        if len(self.new) > REMEMBERED:
            self.old, self.new = self.new, {}
        new, old, out = self.new, self.old, []
        for k in keys:
            if k not in new:
                found = old.get(k)
                if found is None:
                    out.append(k)
                else:
                    new[k] = found
        return out


def _find(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The value of each wanted key, and whether there is one; ``keys`` are sorted."""
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return values[at], keys[at] == wanted


class WordBPE:
    """A tokenizers file whose model is BPE over byte symbols with a suffix at word ends, and which drops white space.

    The file's own normalizer and pre-tokenizer make the words; their merging is ours.
    """

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        model, self.added = file["model"], {t["content"]: t["id"] for t in file["added_tokens"]}
        self.suffix = model.get("end_of_word_suffix") or ""
        library = Tokenizer.from_file(path)
        self.normalizer, self.splitter = library.normalizer, library.pre_tokenizer
        if model["type"] != "BPE" or not self.suffix or model.get("dropout") or any(t["single_word"] or t["normalized"] for t in file["added_tokens"]):
            raise ValueError("wanted: BPE with a suffix at word ends, no dropout, added tokens taken as they stand")
        if [w for w, _ in self.splitter.pre_tokenize_str("a b")] != ["a", "b"]:
            raise ValueError("wanted: a tokenizer that drops white space")
        self.vocab: dict[str, int] = model["vocab"]
        self.names = {i: t for t, i in (self.vocab | self.added).items()}
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.rules = {(self.vocab[a], self.vocab[b]): (rank, self.vocab[a + b]) for rank, (a, b) in reversed(list(enumerate(pairs)))}
        self.final = {t.removesuffix(self.suffix): i for t, i in self.vocab.items() if t.endswith(self.suffix) and t != self.suffix}
        self.inner = {t: i for t, i in self.vocab.items() if not t.endswith(self.suffix)}
        self.special = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        self._edges()
        self._trie()
        self.words, self.chunks = Memory(), Memory()
        split = file["pre_tokenizer"].get("pretokenizers", [{}])[0].get("pattern", {}).get("Regex")
        self.usual = split == USUAL_SPLIT and [n["type"] for n in (file["normalizer"] or {}).get("normalizers", ())] == USUAL_NORMAL

    # Exact merging ---------------------------------------------------------------------------------------------------

    def symbols(self, word: str) -> list[int]:
        try:
            return [*(self.vocab[c] for c in word[:-1]), self.vocab[word[-1] + self.suffix]]
        except KeyError as e:
            raise ValueError(f"the vocabulary has no token for the symbol {e}") from None

    def merge(self, ids: list[int]) -> tuple[list[int], tuple[int, int] | None]:
        """The symbols merged, lowest rank first, leftmost of equals; and the last pair that was merged. n log n in their number."""
        rules, n, last = self.rules, len(ids), None
        ids, after, before = list(ids), [*range(1, n + 1)], [*range(-1, n - 1)]
        queue = [(rules[p][0], i) for i in range(n - 1) if (p := (ids[i], ids[i + 1])) in rules]
        heapq.heapify(queue)
        while queue:
            rank, i = heapq.heappop(queue)
            j = after[i]
            if ids[i] < 0 or j >= n or rules.get((ids[i], ids[j]), (-1,))[0] != rank:
                continue  # one of the two has been merged meanwhile
            last = (ids[i], ids[j])
            ids[i], ids[j] = rules[last][1], -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (p := (ids[i], ids[k])) in rules:
                    heapq.heappush(queue, (rules[p][0], i))
            if (h := before[i]) >= 0 and (p := (ids[h], ids[i])) in rules:
                heapq.heappush(queue, (rules[p][0], h))
        return [i for i in ids if i >= 0], last

    # Speculation and verification -------------------------------------------------------------------------------------

    def _edges(self) -> None:
        """For each token the tokens at its right and left edge with the rank that consumes each, as flat arrays."""
        size = max(self.names) + 1
        split: dict[int, tuple[int, int]] = {}
        self.sound = np.zeros(size, bool)  # tokens whose own symbols merge to them
        for token, i in self.vocab.items():
            stem = token.removesuffix(self.suffix) if token.endswith(self.suffix) and token != self.suffix else None
            text = token if stem is None else stem
            if not all(c in self.vocab for c in text):
                continue
            ids, last = self.merge(self.symbols(text) if stem is not None else [self.vocab[c] for c in text])
            self.sound[i] = ids == [i]
            if last and self.sound[i]:
                split[i] = last
        ranks = {pair: rank for pair, (rank, _) in self.rules.items()}
        made = {i: ranks[pair] for i, pair in split.items()}
        self.ordered = all(made.get(x, -1) < rank for (a, b), rank in ranks.items() for x in (a, b))  # parts before wholes

        def edges(side: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            sizes, tokens, ends = np.zeros(size, np.int64), [], []
            for i in range(size):
                at, end = i, int(NEVER)
                while True:
                    tokens.append(at)
                    ends.append(end)
                    sizes[i] += 1
                    if at not in split:
                        break
                    end, at = made[at], split[at][side]
            return np.concatenate(([0], np.cumsum(sizes))), np.array(tokens, np.int64), np.array(ends, np.int64)

        self.right, self.left = edges(1), edges(0)
        keys = np.array([a * size + b for a, b in ranks], np.int64)
        order = np.argsort(keys)
        self.rule_keys, self.rule_ranks, self.size = keys[order], np.array(list(ranks.values()), np.int64)[order], size
        self.rule_made = np.zeros(max(ranks.values(), default=0) + 1, np.int64)
        for rank, made in self.rules.values():
            self.rule_made[rank] = made

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Of each pair of tokens: is it what its two texts together are encoded to?"""
        if not self.ordered:
            return np.zeros(len(a), bool)
        (r_at, r_tokens, r_ends), (l_at, l_tokens, l_ends) = self.right, self.left
        n_r, n_l = r_at[a + 1] - r_at[a], l_at[b + 1] - l_at[b]
        pair = np.repeat(np.arange(len(a)), n_r * n_l)
        nth = np.arange(len(pair)) - np.repeat(np.cumsum(n_r * n_l) - n_r * n_l, n_r * n_l)
        r, l = r_at[a][pair] + nth // n_l[pair], l_at[b][pair] + nth % n_l[pair]
        key = r_tokens[r] * self.size + l_tokens[l]
        rank, found = _find(self.rule_keys, self.rule_ranks, key)
        rank = np.where(found, rank, NEVER)
        # A rule of the same rank runs from left to right: before one inside the right token, after one inside the left.
        crossed = (rank < r_ends[r]) & (rank <= l_ends[l]) & (rank < NEVER)
        bad = np.zeros(len(a), bool)
        bad[pair[crossed]] = True
        return ~bad & self.sound[a] & self.sound[b]

    def _trie(self) -> None:
        """The tokens as a trie over symbols: byte b is symbol b inside a word and 256 + b at its end."""
        self.code = np.full(1 << 9, -1, np.int64)  # of the characters that spell bytes
        for i, c in enumerate(sorted(c for c in self.inner if len(c) == 1 and c + self.suffix in self.vocab and ord(c) < 1 << 9)):
            self.code[ord(c)] = i
        known = {chr(c): int(i) for c, i in enumerate(self.code) if i >= 0}
        self.base = np.zeros(512, np.int64)
        nodes: dict[tuple[int, int], int] = {}
        tokens = [-1]
        for text, i, end in [*((t, i, 0) for t, i in self.inner.items()), *((t, i, 256) for t, i in self.final.items())]:
            if not all(c in known for c in text):
                continue
            at, path = 0, [known[c] for c in text]
            path[-1] += end
            if len(path) == 1:
                self.base[path[0]] = i
            for symbol in path:
                if (nxt := nodes.get((at, symbol))) is None:
                    nxt = nodes[at, symbol] = len(tokens)
                    tokens.append(-1)
                at = nxt
            tokens[at] = i
        keys = np.array([a * 512 + b for a, b in nodes], np.int64)
        order = np.argsort(keys)
        self.trie_keys, self.trie_next, self.trie_token = keys[order], np.array(list(nodes.values()), np.int64)[order], np.array(tokens, np.int64)

    def _spelled(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The words' symbols in a row, and the place behind each word."""
        points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        symbols = self.code[np.minimum(points, 511)]
        if (symbols < 0).any():
            raise ValueError(f"the vocabulary has no token for the symbol {chr(int(points[symbols < 0][0]))!r}")
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
        symbols[ends - 1] += 256
        return symbols, ends

    def propose(self, symbols: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(tokens, words they belong to): the longest token at each place from left to right, all words side by side."""
        tokens, owners = [], []
        word, at = np.arange(len(ends)), np.concatenate(([0], ends[:-1]))
        while len(word):
            best, size = np.full(len(word), -1), np.zeros(len(word), np.int64)
            live, node, step = np.arange(len(word)), np.zeros(len(word), np.int64), 0
            while len(live):
                node, found = _find(self.trie_keys, self.trie_next, node * 512 + symbols[at[live] + step])
                live, node, step = live[found], node[found], step + 1
                token = self.trie_token[node]
                best[live[token >= 0]], size[live[token >= 0]] = token[token >= 0], step
                more = at[live] + step < ends[word[live]]
                live, node = live[more], node[more]
            tokens.append(best)
            owners.append(word)
            at = at + size
            left = at < ends[word]
            word, at = word[left], at[left]
        owner = np.concatenate(owners)
        order = np.argsort(owner, kind="stable")
        return np.concatenate(tokens)[order], owner[order]

    def merge_all(self, symbols: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
        """Exact merging of many words: in each round every word makes its own next merge, the leftmost of the lowest rank."""
        sizes = np.diff(np.concatenate(([0], ends)))
        ids, owner = self.base[symbols], np.repeat(np.arange(len(ends)), sizes)
        live, done = np.ones(len(ends), bool), []
        while len(ids):
            rank, found = _find(self.rule_keys, self.rule_ranks, ids[:-1] * self.size + ids[1:])
            rank = np.append(np.where(found & (owner[:-1] == owner[1:]), rank, NEVER), NEVER)
            starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            lowest = np.minimum.reduceat(rank, starts)
            rows = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(ids))))
            over = lowest[rows] == NEVER
            done.append((owner[over], ids[over]))
            ids, owner, rank, rows = ids[~over], owner[~over], rank[~over], rows[~over]
            hits = np.flatnonzero(rank == lowest[rows])
            first = hits[np.append(True, owner[hits[1:]] != owner[hits[:-1]])] if len(hits) else hits
            ids[first] = self.rule_made[rank[first]]
            keep = np.ones(len(ids), bool)
            keep[first + 1] = False
            ids, owner = ids[keep], owner[keep]
        owner = np.concatenate([x for x, _ in done])
        order = np.argsort(owner, kind="stable")
        return np.split(np.concatenate([x for _, x in done])[order], np.cumsum(np.bincount(owner, minlength=len(ends)))[:-1])

    def encode_words(self, words: list[str]) -> list[bytes]:
        """The ids of distinct words, each as little-endian unsigned 32-bit integers."""
        symbols, ends = self._spelled(words)
        flat, owner = self.propose(symbols, ends)
        inside = owner[:-1] == owner[1:]
        keys, back = np.unique(flat[:-1][inside] * self.size + flat[1:][inside], return_inverse=True)
        fine = self.compatible(keys // self.size, keys % self.size)[back]
        failed = np.zeros(len(words), bool)
        failed[owner[~self.sound[flat]]] = True
        failed[owner[:-1][inside][~fine]] = True
        cuts = (4 * np.cumsum(np.bincount(owner, minlength=len(words)))).tolist()
        raw = flat.astype("<u4").tobytes()
        out = [raw[a:b] for a, b in zip([0, *cuts[:-1]], cuts)]
        sizes = np.diff(np.concatenate(([0], ends)))
        short = np.flatnonzero(failed & (sizes <= SHORT))
        if len(short):
            mine = np.repeat(failed & (sizes <= SHORT), sizes)
            for i, ids in zip(short.tolist(), self.merge_all(symbols[mine], np.cumsum(sizes[short]))):
                out[i] = ids.astype("<u4").tobytes()
        for i in np.flatnonzero(failed & (sizes > SHORT)).tolist():
            out[i] = np.array(self.merge(self.symbols(words[i]))[0], "<u4").tobytes()
        return out

    # Texts -----------------------------------------------------------------------------------------------------------

    def split(self, parts: list[str]) -> list[list[str]]:
        """The words of each part, a run of text without ASCII white space, in the file's spelling of bytes."""
        plain = [self.usual and p.isascii() and p.isprintable() for p in parts]
        quick: list[list[str]] = [[]]
        for word in _ASCII_WORDS.findall("\n".join(p for p, easy in zip(parts, plain) if easy).lower()):
            if word == "\n":
                quick.append([])
            else:
                quick[-1].append(word)
        ready, other = iter(quick), iter(self._split_by_file([p for p, easy in zip(parts, plain) if not easy]))
        return [next(ready) if easy else next(other) for easy in plain]

    def _split_by_file(self, parts: list[str]) -> list[list[str]]:
        normal = self.normalizer.normalize_str if self.normalizer else str
        joined = " ".join(parts)
        if _ODD_SPACE.search(joined):  # it would be taken for the space between parts
            return [self._split_by_file([p])[0] if not _ODD_SPACE.search(p) else [w for w, _ in self.splitter.pre_tokenize_str(normal(p))] for p in parts]
        text = normal(joined)
        pieces = self.splitter.pre_tokenize_str(text)
        ends = np.cumsum([len(p) + 1 for p in text.split(" ")])
        owners = np.searchsorted(ends, np.fromiter((at[0] for _, at in pieces), np.int64, len(pieces)), side="right")
        words, cuts = [w for w, _ in pieces], np.searchsorted(owners, np.arange(len(parts) + 1)).tolist()
        return [words[a:b] for a, b in zip(cuts, cuts[1:])]

    def _learn(self, chunks: list[str]) -> list[bytes]:
        """The ids of chunks, runs of text without ASCII white space."""
        if self.special and self.special.search(" ".join(chunks)):
            cut = [[x for x in self.special.split(c) if x] for c in chunks]
            found = dict(zip(parts := list({x for c in cut for x in c if x not in self.added}), self._learn_words(parts)))
            found |= {x: i.to_bytes(4, "little") for x, i in self.added.items()}
            return [b"".join([found[x] for x in c]) for c in cut]
        return self._learn_words(chunks)

    def _learn_words(self, parts: list[str]) -> list[bytes]:
        spelled = self.split(parts)
        if unknown := self.words.unknown({w for p in spelled for w in p}):
            self.words.new.update(zip(unknown, self.encode_words(unknown)))
        words = self.words.new
        return [words[p[0]] if len(p) == 1 else b"".join([words[w] for w in p]) for p in spelled]

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """The ids of UTF-8 texts, each as little-endian unsigned 32-bit integers."""
        cut = [t.split() for t in texts]
        unknown = self.chunks.unknown({c for cs in cut for c in cs})
        chunks = self.chunks.new
        for at in range(0, len(unknown), TOGETHER):
            own = unknown[at : at + TOGETHER]
            chunks.update(zip(own, self._learn([c.decode() for c in own])))
        return [b"".join(map(chunks.__getitem__, cs)) for cs in cut]


class Names:
    """Token ids -> text."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        self.decoder = Tokenizer.from_file(path).decoder if file.get("decoder") else None
        self.names = {i: t for t, i in (file["model"]["vocab"] | {t["content"]: t["id"] for t in file["added_tokens"]}).items()}

    def decode(self, ids: bytes) -> str:
        """The tokens' names, joined as the file's decoder does, or by spaces if it has none; unknown ids are left out."""
        names = [x for x in map(self.names.get, np.frombuffer(ids, "<u4").tolist()) if x is not None]
        return self.decoder.decode(names) if self.decoder else " ".join(names)


@lru_cache(maxsize=2)
def word_bpe(path: str) -> WordBPE:
    return WordBPE(path)


@lru_cache(maxsize=2)
def token_names(path: str) -> Names:
    return Names(path)


def _mapped(values: DataFrame, out: str, kind: str, work) -> DataFrame:
    """(an id, ``out``), made from the second, binary column of ``values`` by ``work``, which gets about a megabyte at a time."""
    id_col = values.columns[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        to = pa.string() if kind == "string" else pa.binary()
        for b in batches:
            sizes = np.cumsum(pc.fill_null(pc.binary_length(b.column(1)), 0).to_numpy().astype(np.int64))
            cuts = np.flatnonzero(np.diff(sizes >> 20)) + 1
            for start, end in zip([0, *cuts.tolist()], [*cuts.tolist(), b.num_rows]):
                own = [x or b"" for x in b.column(1).slice(start, end - start).to_pylist()]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(start, end - start), pa.array(work(own), to)], [id_col, out])

    return values.mapInArrow(run, f"`{id_col}` {values.schema[0].dataType.simpleString()}, `{out}` {kind}")


def encode_texts(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(``id_col``, ids binary): the tokens of each whole text, as little-endian unsigned 32-bit integers, nothing added.

    The ids are those of the ``tokenizers`` library for the file at ``tokenizer``, a path that executors can read; strings of its
    added tokens in a text give their ids. Each row is encoded by itself: nothing is shuffled, null ids and repeated rows
    stay, other columns are left out. Null and empty texts, and texts of white space, give no ids. A worker remembers up to twice
    ``REMEMBERED`` chunks and words; words of any length take n log n steps.
    """
    values = docs.select(docs[id_col], docs[text_col].cast("string").cast("binary").alias("_text"))
    return _mapped(values, "ids", "binary", lambda own: word_bpe(tokenizer).encode(own))


def decode_ids(rows: DataFrame, tokenizer: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(``id_col``, text string): each row's ids as text, special tokens included; null gives the empty text."""
    values = rows.select(rows[id_col], rows[ids_col].alias("_ids"))
    return _mapped(values, "text", "string", lambda own: list(map(token_names(tokenizer).decode, own)))
