"""BPE as a deterministic automaton over tokens, and its table-driven encoder and decoder.

Compiling starts from the automaton that has one state and an arc for each byte, and applies one gadget for
each merge (u, v) -> w in rank order: the target of the u-arcs is copied without its v-arc, all u-arcs go to
the copy, and every state with a u-arc gets a w-arc to where v led. After all gadgets the arcs out of the
state behind token a are exactly the tokens that may follow a, and each word has one path: its encoding.

States are not copied in full. Every u-arc leads to one state, so a state is "the target of u as of gadget k",
and the copies differ by the arc that gadget k took away. ``follows`` reads an arc by walking back through the
gadgets: the arc is gone if a gadget up to k took (u, t); else the younger of u and t goes back to the part
that its own gadget made it from (its right part as a source, its left part as a label). So compiling is
linear in the merges, and an arc test takes as many steps as the two tokens have parts on that side.

Encoding walks a byte trie (a table of transitions) for the labels from each position, and keeps for each
position the one token by which a path reaches it. Words of a batch are walked in lockstep with numpy.
"""

from __future__ import annotations

import json

import numpy as np
import regex

SPACE = "\t\n\x0b\x0c\r \x85\xa0  -     　"
#: The byte-level pre-tokenizer's split, with Unicode's White_Space spelt out.
SPLIT = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
NEVER = np.int64(1) << np.int64(40)
LOCKSTEP_BYTES = 24
WORDS_KEPT = 600_000


def byte_symbols() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class ByteTrie:
    """Transitions of a trie over byte strings, in a flat open-addressed table."""

    def __init__(self, labels: dict[bytes, int]):
        children: list[dict[int, int]] = [{}]
        token = [-1]
        for label, t in labels.items():
            node = 0
            for b in label:
                nxt = children[node].get(b)
                if nxt is None:
                    nxt = children[node][b] = len(children)
                    children.append({})
                    token.append(-1)
                node = nxt
            token[node] = t
        self.token = np.array(token, dtype=np.int32)
        self.children = children
        edges = [(node << 8 | b, nxt) for node, row in enumerate(children) for b, nxt in row.items()]
        self.bits = max(4, (4 * len(edges)).bit_length())
        self.key, self.target = np.full(1 << self.bits, -1, np.int64), np.full(1 << self.bits, -1, np.int32)
        key, target = np.array([e[0] for e in edges], np.int64), np.array([e[1] for e in edges], np.int32)
        at = self._slot(key)
        while len(key):
            free = self.key[at] < 0
            self.key[at[free]], self.target[at[free]] = key[free], target[free]  # of edges that want one slot, the last gets it
            on = self.key[at] != key
            key, target, at = key[on], target[on], (at[on] + 1) & ((1 << self.bits) - 1)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def step(self, node: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """The nodes after byte; -1 where there is no transition."""
        key = node.astype(np.int64) << 8 | byte
        at, out = self._slot(key), np.full(len(key), -1, np.int32)
        todo = np.arange(len(key))
        while len(todo):
            found = self.key[at]
            hit = found == key
            out[todo[hit]] = self.target[at[hit]]
            on = ~hit & (found >= 0)
            todo, key, at = todo[on], key[on], (at[on] + 1) & ((1 << self.bits) - 1)
        return out


class MergeAutomaton:
    """Compiled merges; ``encode_words`` and ``decode`` use it."""

    def __init__(self, labels: list[bytes], merges: list[tuple[int, int, int]], special: dict[str, int]):
        """labels: the bytes of each id; merges: (left, right, result) in rank order; special: strings that are one id."""
        n = len(labels)
        self.labels, self.special = labels, special
        self.born, self.left, self.right = np.zeros(n, np.int64), np.full(n, -1, np.int64), np.full(n, -1, np.int64)
        self.gone: dict[int, int] = {}
        self.n = n
        byte_of = {labels[t]: t for t in range(n) if len(labels[t]) == 1 and labels[t]}
        self.dead: set[int] = set(range(n)) - set(byte_of.values())
        self._b, self._l, self._r = self.born.tolist(), self.left.tolist(), self.right.tolist()
        for k, (u, v, w) in enumerate(merges, 1):
            if self._b[w] or w in byte_of.values() and len(labels[w]) == 1:
                raise ValueError(f"token {w} is made by two merges")
            if u in self.dead or v in self.dead or not self.follows(u, v, k - 1):
                continue  # the gadget finds no v-arc behind a u-arc: nothing changes
            self.gone[u * n + v] = k
            self._b[w], self._l[w], self._r[w] = k, u, v
            self.dead.discard(w)
        self.born, self.left, self.right = (np.array(x, np.int64) for x in (self._b, self._l, self._r))
        keys = np.fromiter(self.gone, np.int64, len(self.gone))
        order = np.argsort(keys)
        self.keys, self.times = keys[order], np.fromiter(self.gone.values(), np.int64, len(self.gone))[order]
        self.id_of = {labels[t]: t for t in range(n) if t not in self.dead}
        self.trie = ByteTrie(self.id_of)
        self.longest = max(map(len, self.id_of), default=1)

    @classmethod
    def from_json(cls, text: str) -> MergeAutomaton:
        """From a tokenizers file of a byte-level BPE."""
        spec = json.loads(text)
        model, symbols = spec["model"], byte_symbols()
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*model["vocab"].values(), *special.values()], default=-1) + 1
        labels = [b""] * size
        for s, t in model["vocab"].items():
            labels[t] = bytes(symbols[c] for c in s) if s not in special else s.encode()
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        merges = [(model["vocab"][a], model["vocab"][b], model["vocab"][a + b]) for a, b in pairs]
        out = cls(labels, merges, special)
        for s, t in special.items():
            out.labels[t] = s.encode()
        return out

    def follows(self, u: int, t: int, k: int) -> bool:
        """Whether the state behind u has a t-arc once the first k gadgets are applied."""
        gone, n, born, left, right = self.gone, self.n, self._b, self._l, self._r
        while True:
            if gone.get(u * n + t, NEVER) <= k:
                return False
            bu, bt = born[u], born[t]
            if bu == 0 and bt == 0:
                return True
            if bu > bt:
                u, k = right[u], min(k, bu - 1)
            else:
                t, k = left[t], min(k, bt)

    def follow_all(self, u: np.ndarray, t: np.ndarray) -> np.ndarray:
        """``follows`` after all gadgets for arrays; u < 0 is the start, which has every arc."""
        out = u < 0
        at = np.flatnonzero(~out)
        u, t, k = u[at].astype(np.int64), t[at].astype(np.int64), np.full(len(at), NEVER - 1)
        while len(at):
            key = u * self.n + t
            pos = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1) if len(self.keys) else np.zeros(len(key), np.int64)
            hit = (self.keys[pos] == key) & (self.times[pos] <= k) if len(self.keys) else np.zeros(len(key), bool)
            bu, bt = self.born[u], self.born[t]
            ends = ~hit & (bu == 0) & (bt == 0)
            out[at[ends]] = True
            on = ~hit & ~ends
            at, u, t, k, bu, bt = at[on], u[on], t[on], k[on], bu[on], bt[on]
            back = bu > bt
            k = np.minimum(k, np.where(back, bu - 1, bt))
            u, t = np.where(back, self.right[u], u), np.where(back, t, self.left[t])
        return out

    def encode_word(self, word: bytes) -> list[int]:
        """One word, in plain Python (for words too long for the lockstep)."""
        n, children, token = len(word), self.trie.children, self.trie.token
        last, start = [-1] * (n + 1), [0] * (n + 1)
        for i in range(n):
            u = last[i]
            if i and u < 0:
                continue
            node = 0
            for j in range(i, min(n, i + self.longest)):
                node = children[node].get(word[j], -1)
                if node < 0:
                    break
                t = int(token[node])
                if t >= 0 and last[j + 1] < 0 and (u < 0 or self.follows(u, t, NEVER - 1)):
                    last[j + 1], start[j + 1] = t, i
        out, j = [], n
        while j:
            if last[j] < 0:
                raise ValueError("the vocabulary lacks a byte of the text")
            out.append(last[j])
            j = start[j]
        return out[::-1]

    def encode_words(self, words: list[bytes]) -> list[np.ndarray]:
        """The ids of each word."""
        out: list = [None] * len(words)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        for i in np.flatnonzero(sizes > LOCKSTEP_BYTES):
            out[i] = np.array(self.encode_word(words[i]), np.uint32)
        short = np.flatnonzero(sizes <= LOCKSTEP_BYTES)
        short = short[np.argsort(sizes[short], kind="stable")]
        for lo in range(0, len(short), 8192):
            part = short[lo : lo + 8192]
            for i, ids in zip(part, self._lockstep([words[i] for i in part], sizes[part]), strict=True):
                out[i] = ids
        return out

    def _lockstep(self, words: list[bytes], sizes: np.ndarray) -> list[np.ndarray]:
        m, width = len(words), int(sizes.max(initial=0))
        if not width:
            return [np.zeros(0, np.uint32)] * m
        text = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(m, width).astype(np.int32)
        span = min(width, self.longest)
        label = np.full((span + 1, m, width), -1, np.int32)  # by length of the label and its start
        row, col = (x.ravel() for x in np.meshgrid(np.arange(m), np.arange(width), indexing="ij"))
        on = col < sizes[row]
        row, col = row[on], col[on]
        node = np.zeros(len(row), np.int32)
        for n in range(1, span + 1):
            on = col + n <= sizes[row]
            row, col, node = row[on], col[on], node[on]
            node = self.trie.step(node, text[row, col + n - 1])
            on = node >= 0
            row, col, node = row[on], col[on], node[on]
            if not len(row):
                break
            label[n, row, col] = self.trie.token[node]
        last, start = np.full((m, width + 1), -1, np.int32), np.zeros((m, width + 1), np.int32)
        for j in range(1, width + 1):
            rows = np.flatnonzero(sizes >= j)
            for n in range(1, min(j, span) + 1):
                t = label[n, rows, j - n]
                ok = np.flatnonzero(t >= 0)
                if not len(ok):
                    continue
                r, t = rows[ok], t[ok]
                good = self.follow_all(last[r, j - n], t) & (True if j == n else last[r, j - n] >= 0)
                last[r[good], j], start[r[good], j] = t[good], j - n
                rows = rows[np.isin(rows, r[good], assume_unique=True, invert=True)] if good.any() else rows
        back, at, rows = [], sizes.copy(), np.arange(m)
        while len(rows):
            rows = rows[at[rows] > 0]
            t = last[rows, at[rows]]
            if (t < 0).any():
                raise ValueError("the vocabulary lacks a byte of the text")
            back.append((rows, t))
            at[rows] = start[rows, at[rows]]
        r, t = np.concatenate([x[0] for x in back]), np.concatenate([x[1] for x in back])
        step = np.concatenate([np.full(len(x[0]), i) for i, x in enumerate(back)])
        order = np.lexsort((-step, r))
        cut, ids = [0, *np.cumsum(np.bincount(r, minlength=m)).tolist()], t[order].astype(np.uint32)
        return [ids[a:b] for a, b in zip(cut, cut[1:])]

    def decode(self, ids: list[int]) -> str:
        """The labels of the arcs, as text; bytes that are no UTF-8 become U+FFFD."""
        return b"".join(map(self.labels.__getitem__, ids)).decode("utf-8", "replace")


class TextEncoder:
    """Whole texts to ids; keeps the ids of words that recur."""

    def __init__(self, automaton: MergeAutomaton):
        self.automaton, self.split = automaton, regex.compile(SPLIT)
        self.words: dict[str, bytes] = {}
        self.special = regex.compile("|".join(map(regex.escape, sorted(automaton.special, key=len, reverse=True)))) if automaton.special else None

    def _learn(self, words: set[str]) -> None:
        if len(self.words) > WORDS_KEPT:
            self.words.clear()
        new = [w for w in words if w not in self.words]
        for w, ids in zip(new, self.automaton.encode_words([w.encode() for w in new]), strict=True):
            self.words[w] = ids.tobytes()

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text as the library gives them, without the ids that a post-processor adds."""
        plain: list[str] = []
        plan: list[list[int]] = []  # of each text: places in plain, and -1 - id for special ids
        for text in texts:
            own, at = [], 0
            if self.special and any(s in text for s in self.automaton.special):
                for m in self.special.finditer(text):
                    own += [len(plain), -1 - self.automaton.special[m[0]]]
                    plain.append(text[at : m.start()])
                    at = m.end()
            own.append(len(plain))
            plain.append(text[at:] if at else text)
            plan.append(own)
        made: list[bytes] = []
        lo = 0
        while lo < len(plain):  # so many characters at a time that their words fit in memory
            hi, size = lo, 0
            while hi < len(plain) and (hi == lo or size + len(plain[hi]) < 4_000_000):
                size += len(plain[hi])
                hi += 1
            split = [self.split.findall(t) for t in plain[lo:hi]]
            self._learn(set().union(*split))
            made += [b"".join(map(self.words.__getitem__, x)) for x in split]
            lo = hi
        return [np.frombuffer(b"".join(made[i] if i >= 0 else np.uint32(-1 - i).tobytes() for i in own), "<u4") for own in plan]
