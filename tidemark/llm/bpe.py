"""Byte-pair encoding by a token automaton, and decoding by its arc labels.

The automaton has one state per token: the token read last. At first every state
has an arc for every byte symbol. The merges are then worked in, one gadget each,
in rank order. The gadget of merge ``(u, v) -> w`` does three things:

* state ``u`` loses its arc ``v``: the two tokens never stay side by side;
* every state that has an arc ``u`` gets an arc ``w`` (but ``u`` itself where ``u = v``);
* state ``w`` gets the arcs that state ``v`` has at that moment.

A path through the finished automaton is a tokenization that byte-pair merging
leaves unchanged, and a word has exactly one. Copied arcs are kept as a reference
to the state (or arc) they come from and the rank of the copy, so the tables grow
with the merges and not with states times tokens; an arc that was looked up once
sits in a plain transition table.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame

from tidemark.llm.common import keyed_texts, texts

#: Encoded runs, words and transitions a worker remembers; each is cleared when full.
RUNS, WORDS, TRANSITIONS = 300_000, 100_000, 300_000
#: Python's split takes these for white space, the vocabulary's split doesn't.
CONTROLS = regex.compile("[\x1c-\x1f]")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


class TokenAutomaton:
    """States, arcs and labels compiled from a vocabulary and its merges."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], suffix: str) -> None:
        self.suffix, self.vocab = suffix, vocab
        self.label = {i: t for t, i in vocab.items()}
        self.rank: dict[int, int] = {}  # of the merge that made the token; absent: a symbol
        self.left: dict[int, int] = {}
        self.right: dict[int, int] = {}
        self.lost: dict[tuple[int, int], int] = {}  # arcs taken away, with the rank
        for rank, (a, b) in enumerate(merges):
            u, v, w = vocab[a], vocab[b], vocab[a + b]
            self.lost.setdefault((u, v), rank)
            if u == v:  # of a row of equal tokens the leftmost two join, so none is left before a joined pair
                self.lost.setdefault((u, w), rank)
            if w not in self.rank:
                self.rank[w], self.left[w], self.right[w] = rank, u, v
        # the tokens as a tree of symbols: [token that ends here, token that ends a word here, branches]
        self.tree: list = [-1, -1, {}]
        for token, i in vocab.items():
            plain = token.removesuffix(suffix) or token
            if i in self.rank or len(plain) == 1:
                node = self.tree
                for symbol in plain:
                    node = node[2].setdefault(symbol, [-1, -1, {}])
                node[plain != token] = i
        self.known: dict[int, bool] = {}  # by state * size + token
        self.size = max(vocab.values(), default=0) + 1

    def has_arc(self, state: int, token: int) -> bool:
        """Whether ``token`` may follow ``state`` in the finished automaton."""
        key = state * self.size + token
        found = self.known.get(key)
        if found is None:
            if len(self.known) > TRANSITIONS:
                self.known.clear()
            found = self.known[key] = self._arc(state, token)
        return found

    def _arc(self, state: int, token: int) -> bool:
        before = len(self.lost) + len(self.rank) + 1
        while True:
            if self.lost.get((state, token), before) < before:
                return False
            # the younger of the two was made from an arc or state that existed then
            made, other = self.rank.get(token, -1), self.rank.get(state, -1)
            if made < 0 and other < 0:
                return True
            if made >= other:
                token, before = self.left[token], made
            else:
                state, before = self.right[state], other

    def path(self, word: str) -> list[int]:
        """The arcs of the one path that spells ``word`` (in byte symbols).

        The longest arc is tried first. A place in the word has one state, whichever
        way it was reached, so a place from which no arc leads on is never tried again.
        """
        size, known, tree, states = len(word), self.known, self.tree, self.size
        out: list[int] = []
        options: list[list[tuple[int, int]]] = []
        ends = [0]
        dead: set[int] = set()
        while ends[-1] < size:
            at = ends[-1]
            if len(options) < len(ends):  # new here: all tokens that start at this place
                node, found = tree, []
                for end in range(at + 1, size + 1):
                    node = node[2].get(word[end - 1])
                    if node is None:
                        break
                    token = node[end == size]
                    if token >= 0:
                        found.append((end, token))
                options.append(found)
            found = options[-1]
            while found:
                end, token = found.pop()
                if end in dead:
                    continue
                if out:
                    fits = known.get(out[-1] * states + token)
                    if fits is None:
                        fits = self.has_arc(out[-1], token)
                    if not fits:
                        continue
                out.append(token)
                ends.append(end)
                break
            else:
                if not out:
                    raise ValueError(f"no path spells {word!r}")
                dead.add(ends.pop())
                options.pop()
                out.pop()
        return out


class WordEncoder:
    """Normalises and splits a text into words, and encodes each by the automaton."""

    #: The split of the vocabulary's definition, with its white space spelled out.
    SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\p{White_Space}\p{L}\p{N}]+"

    def __init__(self, definition: str) -> None:
        spec = json.loads(definition)
        model = spec["model"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.automaton = TokenAutomaton(model["vocab"], merges, model["end_of_word_suffix"] or "")
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.labels = self.automaton.label | {i: t for t, i in self.special.items()}
        self.parts = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.split = regex.compile(self.SPLIT)
        self.symbols = byte_symbols()
        self.words: dict[str, tuple[int, str, str]] = {}
        self.chunks: dict[str, tuple[int, str, str]] = {}

    def word(self, word: str) -> tuple[int, str, str]:
        """Count of ids, the ids and the labels of a word, each joined by a space."""
        found = self.words.get(word)
        if found is None:
            if len(self.words) > WORDS:
                self.words.clear()
            ids = self.automaton.path("".join([self.symbols[b] for b in word.encode()]))
            found = self.words[word] = (len(ids), " ".join(map(str, ids)), " ".join([self.labels[i] for i in ids]))
        return found

    def chunk(self, chunk: str) -> tuple[int, str, str]:
        """The same of a run without white space."""
        if len(self.chunks) > RUNS:
            self.chunks.clear()
        found = self.chunks[chunk] = _joined([self.word(w) for w in self.split.findall(chunk)])
        return found

    def _plain(self, text: str) -> list[tuple[int, str, str]]:
        if not text.isascii():
            # each character is lower-cased by itself, so a final sigma has no form of its own
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        text = text.lower()
        if CONTROLS.search(text):
            return [self.word(w) for w in self.split.findall(text)]
        get, chunk = self.chunks.get, self.chunk
        return [get(c) or chunk(c) for c in text.split()]

    def encode(self, text: str) -> tuple[int, str, str]:
        """Number of ids, ids and decoded text of a whole text, each joined by a space."""
        done, at = [], 0
        for m in self.parts.finditer(text) if self.parts else ():
            done += self._plain(text[at : m.start()])
            done.append((1, str(self.special[m[0]]), m[0]))
            at = m.end()
        return _joined(done + self._plain(text[at:] if at else text))


def _joined(parts: list[tuple[int, str, str]]) -> tuple[int, str, str]:
    n, ids, labels = zip(*[p for p in parts if p[0]]) if any(p[0] for p in parts) else ((), (), ())
    return sum(n), " ".join(ids), " ".join(labels)


_ENCODERS: dict[str, WordEncoder] = {}


def _encoder(name: str) -> WordEncoder:
    """The encoder of a file that Spark has sent to this machine; compiled once per worker."""
    if name not in _ENCODERS:
        with open(SparkFiles.get(name), encoding="utf-8") as file:
            _ENCODERS[name] = WordEncoder(file.read())
    return _ENCODERS[name]


def encode_documents(
    docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", full: bool = False
) -> DataFrame:
    """One row per document: ``doc_id, n_tokens, ids_sha256, decoded_sha256``.

    ``vocabulary`` is the path of a tokenizer definition on the driver; Spark sends
    the file to the executors. With ``full`` the ids (``ids array<int>``) and the
    decoded text (``decoded``) come too. Null reads as the empty text, which has no
    ids and decodes to itself.
    """
    docs.sparkSession.sparkContext.addFile(vocabulary)
    name = vocabulary.rsplit("/", 1)[-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(name).encode
        for batch in batches:
            done = [encode(t.decode()) for t in texts(batch)]
            columns = {
                "doc_id": batch.column("doc_id"),
                "n_tokens": pa.array([n for n, _, _ in done], pa.int64()),
                "ids_sha256": pa.array([hashlib.sha256(i.encode()).hexdigest() for _, i, _ in done], pa.string()),
                "decoded_sha256": pa.array([hashlib.sha256(t.encode()).hexdigest() for _, _, t in done], pa.string()),
            }
            if full:
                columns["ids"] = pa.array([[int(x) for x in i.split()] for _, i, _ in done], pa.list_(pa.int32()))
                columns["decoded"] = pa.array([t for _, _, t in done], pa.string())
            yield pa.RecordBatch.from_pydict(columns)

    rows = keyed_texts(docs, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()
    more = ", ids array<int>, decoded string" if full else ""
    return rows.mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string{more}")
