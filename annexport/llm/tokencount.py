"""Token counts by a compiled finite-state transducer.

For a BPE vocabulary with word ends, the number of tokens of a word's prefix follows from the tokens
that end at its last few places: the last token of a prefix's encoding is the one that is compatible
with the last token before it (two tokens are compatible if encoding their joined text gives just
them). So a deterministic transducer needs as its state only the longest suffix that can still
begin a token, with the last token and the relative count at each of its places. Each transition is
annotated with the tokens it emits, which may be negative when a longer token replaces several.
States and transitions are compiled when first met and kept, up to a bound, per Python worker.
Around the words, states for letters, numbers, signs and contractions part the text.

A long text is cut into chunks. A chunk's state map says where each entry state leads and what it
emits. White space leads from every state to the first one, so a map is the chunk's head before its
first white space, which is followed from the entry state, and one exit and count for the rest.
Maps compose associatively; ``scan`` composes all prefixes in a logarithmic number of rounds.

Special tokens inside a text are tokens of their own, found before anything else, as the library does.

Edge cases: NULL and empty texts have no tokens. Texts of any length, also one endless word, are
counted whole. Repeated rows get equal results. Extra columns pass through; columns named like the
results are replaced.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers.normalizers import Lowercase

from annexport.llm.common import give_back, in_batches, utf8, worker_cache

CHUNK = 1 << 16  # characters
NODES = 150_000  # states kept per worker
END = "</w>"  # fixed: the mark of a word's end in the vocabulary
# The contractions of the pre-tokenizer, without the apostrophe.
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")
NEVER = 1 << 30


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters, extra = {b: chr(b) for b in plain}, 0
    for b in range(256):
        if b not in letters:
            letters[b] = chr(256 + extra)
            extra += 1
    return [letters[b] for b in range(256)]


LETTERS = byte_letters()


class Vocabulary:
    """Merge ranks, tokens and special tokens of a tokenizer file."""

    def __init__(self, content: bytes) -> None:
        spec = json.loads(content)
        self.merges = {tuple(pair): rank for rank, pair in enumerate(spec["model"]["merges"])}
        self.tokens = set(spec["model"]["vocab"])
        self.special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)


class Words:
    """The transducer inside a word: states, transitions and the counts they emit."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.merges = vocabulary.merges
        self.joined: dict[tuple, bool] = {}
        whole = [t for t in vocabulary.tokens if self._alone(t)]
        self.inner = {t for t in whole if not t.endswith(END)}
        self.final = {t[: -len(END)] for t in whole if t.endswith(END)}
        # What may still become a token, or is one if the word ends here.
        self.prefixes = {t[:k] for t in self.inner for k in range(len(t))} | {
            t[:k] for t in self.final for k in range(len(t) + 1)
        }

    def encode(self, symbols: list[str]) -> list[str]:
        """Plain BPE of a few symbols: the least-ranked pair first, leftmost of equals."""
        symbols = list(symbols)
        while len(symbols) > 1:
            best, at = min((self.merges.get((a, b), NEVER), i) for i, (a, b) in enumerate(zip(symbols, symbols[1:])))
            if best == NEVER:
                break
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
        return symbols

    def _symbols(self, token: str) -> list[str]:
        if token.endswith(END) and token != END:
            body = token[: -len(END)]
            return [*body[:-1], body[-1] + END]
        return list(token)

    def _alone(self, token: str) -> bool:
        return self.encode(self._symbols(token)) == [token]

    def compatible(self, left: str | None, right: str) -> bool:
        if left is None:
            return True
        key = (left, right)
        found = self.joined.get(key)
        if found is None:
            if len(self.joined) > 500_000:
                self.joined.clear()
            found = self.joined[key] = self.encode([*left, *self._symbols(right)]) == [left, right]
        return found

    # A state: (suffix, last tokens, relative counts), the latter two at the places 0.. before its end.
    START = ("", (None,), (0,))

    def step(self, state: tuple, letter: str) -> tuple[tuple, int]:
        """The state after one more letter inside the word, and the tokens it emits."""
        suffix, last, counts = state
        suffix += letter
        for k in range(len(suffix), 0, -1):
            token = suffix[-k:]
            if token in self.inner and self.compatible(last[k - 1], token):
                break
        emitted = counts[k - 1] + 1
        start = 0
        while suffix[start:] not in self.prefixes:
            start += 1
        keep = len(suffix) - start
        return (
            suffix[start:], (token, *last[:keep]), (0, *[c - emitted for c in counts[:keep]]),
        ), emitted

    def finish(self, state: tuple) -> int:
        """Tokens emitted when the word ends here: its last letter becomes a word end."""
        suffix, last, counts = state
        for k in range(len(suffix), 0, -1):
            token = suffix[-k:]
            if token in self.final and self.compatible(last[k], token + END):
                return counts[k] + 1
        raise AssertionError("every letter is a final token by itself")


class Node(dict):
    """A state of the whole transducer: character -> (next node, emitted tokens).

    ``kind``: of the pre-token that is open: "" none, L letters, N a number, O signs, or the begin
    of a contraction; ``word`` is the state inside it.
    """

    __slots__ = ("machine", "kind", "word", "text")

    def __init__(self, machine: Machine, kind: str, word: tuple, text: str = "") -> None:
        super().__init__()
        self.machine, self.kind, self.word, self.text = machine, kind, word, text

    def __missing__(self, char: str) -> tuple[Node, int]:
        found = self[char] = self.machine.transition(self, char)
        return found


_LETTER, _NUMBER, _SPACE = regex.compile(r"\p{L}"), regex.compile(r"\p{N}"), regex.compile(r"\s")


class Machine:
    def __init__(self, vocabulary: Vocabulary) -> None:
        self.words = Words(vocabulary)
        self.nodes: dict[tuple, Node] = {}
        self.first = self.node("", Words.START)
        self.special = regex.compile("|".join(map(regex.escape, vocabulary.special))) if vocabulary.special else None

    def node(self, kind: str, word: tuple, text: str = "") -> Node:
        key = (kind, word, text)
        if key not in self.nodes:
            self.nodes[key] = Node(self, kind, word, text)
        return self.nodes[key]

    def trim(self) -> None:
        """Forgets all states, between texts, when there are too many."""
        if len(self.nodes) > NODES:
            for node in self.nodes.values():
                node.clear()
            self.nodes.clear()
            self.first = self.node("", Words.START)

    def _spell(self, word: tuple, text: str) -> tuple[tuple, int]:
        total = 0
        for byte in text.encode():
            word, emitted = self.words.step(word, LETTERS[byte])
            total += emitted
        return word, total

    def _open(self, char: str) -> tuple[Node, int]:
        """The first character of a pre-token."""
        if _SPACE.match(char):
            return self.first, 0
        if char == "'":
            word, emitted = self._spell(Words.START, char)
            return self.node("'", word, char), emitted
        word, emitted = self._spell(Words.START, char)
        if _LETTER.match(char):
            return self.node("L", word), emitted
        if _NUMBER.match(char):  # a number is a pre-token of one character
            return self.first, emitted + self.words.finish(word)
        return self.node("O", word), emitted

    def _fail(self, node: Node) -> tuple[Node, int]:
        """A contraction that did not come to an end: the apostrophe is a sign, the rest letters.

        The tokens emitted so far are of the contraction's begin and are taken back.
        """
        _, before = self._spell(Words.START, node.text)
        sign, emitted = self._spell(Words.START, "'")
        total = emitted - before
        if len(node.text) == 1:
            return self.node("O", sign), total
        total += self.words.finish(sign)
        word, emitted = self._spell(Words.START, node.text[1:])
        return self.node("L", word), total + emitted

    def transition(self, node: Node, char: str) -> tuple[Node, int]:
        kind = node.kind
        if kind == "'":
            text = node.text + char
            if text[1:] in CONTRACTIONS:
                word, emitted = self._spell(node.word, char)
                return self.first, emitted + self.words.finish(word)
            if any(c.startswith(text[1:]) for c in CONTRACTIONS):
                word, emitted = self._spell(node.word, char)
                return self.node("'", word, text), emitted
            other, back = self._fail(node)
            after, emitted = self.transition(other, char)
            return after, back + emitted
        if kind == "":
            return self._open(char)
        same = bool(_LETTER.match(char)) if kind == "L" else not (
            _LETTER.match(char) or _NUMBER.match(char) or _SPACE.match(char)
        )
        if same:
            word, emitted = self._spell(node.word, char)
            return self.node(kind, word), emitted
        ended = self.words.finish(node.word)
        after, emitted = self._open(char)
        return after, ended + emitted

    def end(self, node: Node) -> int:
        """Tokens emitted at the end of a text."""
        if node.kind == "":
            return 0
        if node.kind == "'":
            other, back = self._fail(node)
            return back + self.words.finish(other.word)
        return self.words.finish(node.word)

    def run(self, node: Node, text: str) -> tuple[Node, int]:
        total = 0
        for char in text:
            node, emitted = node[char]
            total += emitted
        return node, total

    # --- chunk state maps: (head, rest), rest = (exit, count) or None when no white space resets it

    def state_map(self, chunk: str) -> tuple[str, tuple[Node, int] | None]:
        at = chunk.find(" ")
        if at < 0:
            return chunk, None
        return chunk[: at + 1], self.run(self.first, chunk[at + 1 :])

    def compose(self, a: tuple, b: tuple) -> tuple:
        """The map of a chunk followed by another."""
        (head, rest), (next_head, next_rest) = a, b
        if rest is None:
            return head + next_head, next_rest
        node, count = self.run(rest[0], next_head)
        if next_rest is None:
            return head, (node, rest[1] + count)
        return head, (next_rest[0], rest[1] + count + next_rest[1])

    def scan(self, maps: list[tuple]) -> list[tuple]:
        """All prefix compositions, in rounds over growing distances."""
        distance = 1
        while distance < len(maps):
            maps = [self.compose(maps[i - distance], m) if i >= distance else m for i, m in enumerate(maps)]
            distance *= 2
        return maps

    def count(self, text: str) -> int:
        """Tokens of a normalised text."""
        if len(text) <= CHUNK:
            node, total = self.run(self.first, text)
            return total + self.end(node)
        maps = [self.state_map(text[k : k + CHUNK]) for k in range(0, len(text), CHUNK)]
        head, rest = self.scan(maps)[-1]
        node, total = self.run(self.first, head)
        if rest is not None:
            node, total = rest[0], total + rest[1]
        return total + self.end(node)

    def tokens(self, text: str) -> int:
        """Tokens of any text, special tokens included."""
        self.trim()
        if self.special is None or "<" not in text:
            return self.count(normalised(text))
        parts = self.special.split(text)
        return len(parts) - 1 + sum(self.count(normalised(p)) for p in parts if p)


_BLANKS = regex.compile(r"\s+")


@lru_cache(maxsize=1)
def case_exceptions() -> tuple[regex.Pattern | None, dict[int, str]]:
    """The characters whose lower case the library's normaliser gives otherwise than ``str.lower``: the
    two may follow different versions of Unicode."""
    every = [chr(c) for c in range(0x80, 0x110000) if not 0xD800 <= c < 0xE000]
    lowered = Lowercase().normalize_str("\n".join(every)).split("\n")
    other = {ord(a): b for a, b in zip(every, lowered) if a.lower() != b}
    return regex.compile("[" + "".join(map(chr, other)) + "]") if other else None, other


def normalised(text: str) -> str:
    """Composed (NFC), runs of white space as one blank, lower case character by character."""
    text = _BLANKS.sub(" ", unicodedata.normalize("NFC", text))
    pattern, other = case_exceptions()
    if pattern is not None and pattern.search(text):
        text = text.translate(other)
    # str.lower() treats a final capital sigma in its own way; character by character it is plain.
    return "".join(map(str.lower, text)) if "Σ" in text else text.lower()



def worker_machine(key: str, shared) -> Machine:
    """The worker's machine of a broadcast vocabulary file; its states are kept from task to task."""
    return worker_cache(f"tokens {key}", lambda: Machine(Vocabulary(shared.value)))


def token_counts(docs: DataFrame, path: str, text: str = "text", into: str = "n_tokens") -> DataFrame:
    """``docs`` with the number of tokens of the whole text in column ``into``.

    The vocabulary file is read on the driver; its broadcast has the file's size.
    """
    with open(path, "rb") as file:
        content = file.read()
    key, shared = hashlib.sha256(content).hexdigest(), docs.sparkSession.sparkContext.broadcast(content)

    @F.arrow_udf("long")
    def of(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        counter = worker_machine(key, shared)
        for batch in texts:
            yield pa.array([counter.tokens(t.decode()) for t in utf8(batch)], pa.int64())
            give_back()

    return in_batches(docs).withColumn(into, of(F.col(text)))
