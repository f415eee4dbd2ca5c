"""Token counts by a compiled finite-state transducer.

The BPE model of a sentencepiece file is compiled, state by state as texts need them, into a deterministic transducer. A
state is what the segmentation of the text so far can still influence: the longest suffix that begins some piece and, for
each cut inside that suffix, the last token before the cut and the token count there. (A segmentation is the library's
if each two neighbouring tokens alone give those two tokens again, so the last token before a cut is all that must be
known of what precedes it.) Every transition is annotated with the change of the token count.

A symbol that no piece joins to what stands before it resets the transducer: the space marker after anything else, and
any character outside the vocabulary, which becomes one token a byte. The state map of a chunk that begins at such a
symbol is constant, so it is a pair (tokens emitted, exit state); chunks cut elsewhere keep their head up to the first
reset for the entry state. ``ChunkMap.then`` composes maps associatively. Most texts are cut at resets: their maps are all
constant, and the prefix scan that composes them is a sum. Texts with several spaces together, a leading one or the marker
itself are cut every CHUNK characters, and their maps are composed pair by pair.

Nulls count as empty texts (0 tokens); empty texts have 0 tokens; repeated rows give repeated results; other columns,
whatever their names, are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillgrid.llm.common import coded, empty_if_null, slices, tidy, tokenizer_path

MARK = "▁"  # how the model writes a space
START = 0  # the state in which nothing before can matter
MEMO_WORDS = 200_000  # chunk maps kept by one task
MAX_STATES = 600_000  # states kept by one task; beyond it compiling starts anew
CHUNK = 512  # characters of a text whose chunks do not begin at resets
LONG_CHUNK = 48  # longer chunks are run, not kept


@dataclass(frozen=True)
class ChunkMap:
    """What a chunk of text does to any entry state: ``head`` must be run from it; a reset, if there is one, fixes the rest."""

    head: str
    resets: bool
    count: int = 0
    exit: int = START

    def then(self, other: ChunkMap, run) -> ChunkMap:
        """This chunk followed by the other one."""
        if not self.resets:
            return ChunkMap(self.head + other.head, other.resets, other.count, other.exit)
        count, state = run(other.head, self.exit)
        if other.resets:
            return ChunkMap(self.head, True, self.count + count + other.count, other.exit)
        return ChunkMap(self.head, True, self.count + count, state)


class BpeTransducer:
    """Token counts of one sentencepiece BPE model."""

    def __init__(self, model_file: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        ids = range(sp.get_piece_size())
        self.score = {sp.id_to_piece(i): sp.get_score(i) for i in ids if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))}
        self.begins = {p[:k] for p in self.score for k in range(1, len(p))}
        letters = {c for p in self.score for c in p}
        if letters - self.score.keys():
            raise ValueError("a piece has a character that is no piece itself")
        #: The marker stands at a piece's start only, or in pieces of markers alone: then it resets after any other character.
        self.mark_resets = not any(MARK in p.lstrip(MARK) for p in self.score)
        self._forget()

    def _forget(self) -> None:
        self.keys = [((), "")]
        self.known = {self.keys[0]: START}
        self.next: list[dict[str, tuple[int, int]]] = [{}]
        self.joins: dict[tuple[str, str], bool] = {}

    def merge(self, text: str) -> list[str]:
        """The model's own rule on a few characters: join the best-scored neighbours, leftmost first, while any pair is a piece."""
        parts = list(text)
        while len(parts) > 1:
            best = max(((self.score[p], -i) for i in range(len(parts) - 1) if (p := parts[i] + parts[i + 1]) in self.score), default=None)
            if best is None:
                break
            i = -best[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def _apart(self, left: str, right: str) -> bool:
        """Whether these tokens, side by side, stay as they are."""
        key = (left, right)
        if (said := self.joins.get(key)) is None:
            said = self.joins[key] = self.merge(left + right) == ([left, right] if left else [right])
        return said

    def step(self, state: int, c: str) -> tuple[int, int]:
        """The next state and the change of the count; compiles the transition when it is new."""
        if (known := self.next[state].get(c)) is not None:
            return known
        if c not in self.score:
            made = (START, len(c.encode("utf-8", "surrogatepass")))
        else:
            cuts, suffix = self.keys[state]
            if self.mark_resets and c == MARK and suffix[-1:] != MARK:
                cuts, suffix = (), ""
            # cuts: (characters since the cut, last token before it, tokens there less tokens here); one at 0 is where we stand
            here = cuts or ((0, "", 0),)
            text = suffix + c
            token, delta = next((text[len(text) - 1 - d :], n + 1) for d, last, n in here if text[len(text) - 1 - d :] in self.score and self._apart(last, text[len(text) - 1 - d :]))
            kept = [(d + 1, last, n - delta) for d, last, n in here if text[len(text) - 1 - d :] in self.begins]
            longest = max((d for d, _, _ in kept), default=0)
            # nothing joins on to it: what comes next is as at the start
            key = ((*kept, (0, token, 0)), text[len(text) - longest :]) if longest else (((0, token, 0),), "")
            target = self.known.get(key)
            if target is None:
                target = self.known[key] = len(self.keys)
                self.keys.append(key)
                self.next.append({})
            made = (target, delta)
        self.next[state][c] = made
        return made

    def run(self, text: str, state: int = START) -> tuple[int, int]:
        """Tokens emitted over text from a state, and the state after it."""
        total, following = 0, self.next
        for c in text:
            found = following[state].get(c)
            state, emitted = found if found is not None else self.step(state, c)
            total += emitted
        return total, state

    def chunk_map(self, chunk: str) -> ChunkMap:
        """The state map of a chunk cut anywhere. A reset is a marker after another character, or a character that is no piece."""
        at = next((i for i, c in enumerate(chunk) if c not in self.score or (self.mark_resets and c == MARK and i and chunk[i - 1] != MARK)), None)
        if at is None:
            return ChunkMap(chunk, False)
        return ChunkMap(chunk[:at], True, *self.run(chunk[at:]))


class Counter(dict):
    """The transducer with the counts of chunks that stand alone: each begins at a reset and ends where the next begins.

    A chunk is named by its text; it follows a space, unless it begins with a line feed. The first MEMO_WORDS short ones
    met are kept, among them the frequent ones; others are run again.
    """

    def __init__(self, model_file: str):
        super().__init__()
        self.transducer = BpeTransducer(model_file)
        if "\n" in self.transducer.score or not self.transducer.mark_resets:
            raise ValueError("the space marker and the line feed must reset the model")

    def __missing__(self, chunk: str) -> int:
        count = self.transducer.run(chunk if chunk[:1] == "\n" else MARK + chunk)[0]
        if len(chunk) <= LONG_CHUNK and len(self) < MEMO_WORDS:
            self[chunk] = count
        return count

    def totals(self, texts: pa.Array) -> np.ndarray:
        """Tokens of each text: its chunks' maps composed by a prefix scan."""
        joined = pc.or_(pc.match_substring(texts, "  "), pc.or_(pc.match_substring(texts, MARK), pc.starts_with(texts, " ")))
        words, codes, ends = coded(pc.split_pattern(pc.replace_substring(texts, "\n", " \n"), " "))
        counts = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        scan = np.concatenate([[0], np.cumsum(counts[codes])])
        out = scan[ends[1:]] - scan[ends[:-1]]
        bare = np.asarray(pc.starts_with(texts, "\n"))
        out -= np.asarray(pc.equal(pc.binary_length(texts), 0))  # nothing is not even a space
        for k in np.flatnonzero(np.asarray(joined) | bare):  # several spaces may be one piece
            out[k] = self.composed(MARK + texts[int(k)].as_py().replace(" ", MARK))
        return out

    def composed(self, text: str) -> int:
        """Tokens of a text cut anywhere: the maps of its chunks, composed pair by pair. A chunk without a reset only joins its
        text to what follows, so each character is run once."""
        t = self.transducer
        maps = [t.chunk_map(text[at : at + CHUNK]) for at in range(0, len(text), CHUNK)]
        while len(maps) > 1:
            maps = [a.then(b, t.run) for a, b in zip(maps[::2], maps[1::2], strict=False)] + maps[len(maps) & ~1 :]
        return t.run(maps[0].head)[0] + maps[0].count


_held: dict[str, Counter] = {}


def _counter(model_file: str) -> Counter:
    got = _held.get(model_file)
    if got is None:
        got = _held[model_file] = Counter(model_file)
    if len(got.transducer.keys) > MAX_STATES:
        got.transducer._forget()
    return got


def count_tokens(docs: DataFrame, model_file: str | None = None, id_col: str = "doc_id", text_col: str = "text", limit: int = 4096) -> DataFrame:
    """id, n_bytes (UTF-8), n_tokens as the library counts them, over_limit (n_tokens > limit), for every row of docs."""
    path = model_file or tokenizer_path("piece_bpe_32k.model")
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias(id_col), empty_if_null(F.col(f"`{text_col}`")).alias("text"))
    rows = rows.withColumn("n_bytes", F.octet_length("text").cast("long"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            totals = [pa.array(_counter(path).totals(texts)) for _, texts in slices(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.concat_arrays(totals)], names=[id_col, "n_bytes", "n_tokens"])

    out = rows.mapInArrow(tidy(count), f"`{id_col}` long, n_bytes long, n_tokens long")
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
