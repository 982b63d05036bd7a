"""SentencePiece encoding and decoding: one pass of an Aho-Corasick automaton over the pieces.

The automaton reports, at each position, every piece that ends there (its output links). What is kept of each prefix is
the last piece of its encoding.

* A model trained by merges: the piece that ends a prefix is the one output link that fits the last piece of the prefix it
  extends: the text of the two, merged in the model's order, must give back those two. A sequence is what merging gives
  exactly if all its neighbours fit (a merge across a border would already be the next one in the text of the two alone),
  so exactly one link fits, and the ids are those of the model. How each piece comes about alone is worked out once;
  whether two pieces fit follows from these two histories and is remembered.
* A unigram model: each link relaxes the best score of its position (Viterbi).

A character that no one-character piece covers falls back to its UTF-8 bytes (unigram: at a penalty below every score). A text
gets a space in front and spaces become U+2581, as the model asks; a U+2581 of the text itself is written as bytes, so
that decoding is exact for every text (the public library makes it a space).

Pieces hold U+2581 only at their start and no line break, so a segmentation can't cross the beginning of a run of spaces
or a line break: the segmentation of a text is that of its segments, each worked out once and remembered
(up to CACHE segments in a Python worker, over its tasks). A segment is cut once more between two characters that no piece holds side by side, since no merge
can cross there: a word is worked out once, whatever marks follow it. A model for which this is not so is rejected, and so is a merge-trained one with unused pieces.

The model is a parameter and is never trained.
A null or empty text has no ids. Rows are encoded one by one; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyguard.llm.common import kept, map_texts, received, send

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
CACHE = 200_000
#: Pairs of pieces that are remembered.
PAIRS = 1_000_000
#: Bytes of text that one output batch stands for.
BATCH_BYTES = 1 << 21


class Pieces:
    """A model's pieces and scores, read by the public library; plain data that can be sent to tasks."""

    #: Score by piece, and the histories of the pieces that merging can give; only of a model trained by merges.
    ranks: dict[str, float] | None = None
    histories: dict[int, tuple[list, list]] = {}
    #: The encoder of a Python worker.
    encoder: Encoder | None = None

    def __init__(self, path: str = MODEL):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.bytes = {int(model.id_to_piece(i)[3:5], 16): i for i in range(size) if model.is_byte(i)}
        self.text = {i: model.id_to_piece(i) for i in range(size) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))}
        self.score = {i: model.get_score(i) for i in self.text}
        self.size, self.unknown = size, model.unk_id()
        self.check()
        # A model trained by merges holds the negative ranks of its merges.
        if len(set(self.score.values())) > 2 and all(x <= 0 and x == int(x) for x in self.score.values()):
            if any(model.is_unused(i) for i in range(size)):
                raise ValueError("a model trained by merges has unused pieces")
            self.ranks = {p: self.score[i] for i, p in self.text.items()}
            self.histories = {i: h for i, p in self.text.items() if (h := self.history(p))}

    def history(self, piece: str) -> tuple[list, list] | None:
        """How a piece comes about by merging its characters, best score first, leftmost of equals: after each number of merges
        the score of the next one (the last: none) and the part at the left end, and the same for the right end.
        None if merging doesn't give the piece."""
        parts, left, right = list(piece), [], []
        while len(parts) > 1:
            score, at = max((self.ranks.get(parts[i] + parts[i + 1], -np.inf), -i) for i in range(len(parts) - 1))
            if score == -np.inf:
                return None
            left.append((score, parts[0]))
            right.append((score, parts[-1]))
            parts[-at : 2 - at] = [parts[-at] + parts[1 - at]]
        return [*left, (-np.inf, piece)], [*right, (-np.inf, piece)]

    def check(self) -> None:
        if any(SPACE in p.lstrip(SPACE) or "\n" in p for p in self.text.values()):
            raise ValueError("a piece crosses the beginning of a run of spaces or a line break")
        if len(self.bytes) != 256:
            raise ValueError("the model has no piece for each byte")

    def decoded(self) -> list[bytes]:
        """The bytes that each id stands for."""
        out = [b""] * self.size
        for value, i in self.bytes.items():
            out[i] = bytes([value])
        for i, p in self.text.items():
            out[i] = p.replace(SPACE, " ").encode()
        return out


class Encoder:
    def __init__(self, pieces: Pieces):
        import re

        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        self.ranks, self.histories = pieces.ranks, pieces.histories
        for i, p in pieces.text.items():
            if self.ranks is None or i in self.histories:
                self.automaton.add_word(p, (len(p), pieces.score[i], i))
        self.automaton.make_automaton()
        self.single = frozenset(p for p in pieces.text.values() if len(p) == 1)
        self.fallback = min(pieces.score.values()) - 10.0
        self.bytes = pieces.bytes
        self.cuts = re.compile(r" +[^ \n]*|[^ \n]+|\n")
        self.seen: dict[str, tuple[int, ...]] = {}
        self.pairs: dict[tuple[int, int], bool] = {}
        #: Characters that stand side by side in a piece, and the ids of what is cut between others.
        self.joined = frozenset(p[k : k + 2] for p in pieces.text.values() for k in range(len(p) - 1))
        self.parts: dict[str, tuple[int, ...]] = {}
        self.best = self.viterbi if self.ranks is None else self.apart

    def fits(self, left: int, right: int) -> bool:
        """Whether two neighbours stay apart when their text is merged in the model's order. Up to a merge across the border
        each side goes through its own history, the better score next, the left of equals."""
        known = self.pairs.get((left, right))
        if known is None:
            a = self.histories[left][1] if left >= 0 else [(-np.inf, chr(-1 - left))]
            b = self.histories[right][0] if right >= 0 else [(-np.inf, chr(-1 - right))]
            i = j = 0
            while True:
                (x, end), (y, begin) = a[i], b[j]
                across = self.ranks.get(end + begin, -np.inf)
                if across > x and across >= y:
                    known = False
                elif x == y == -np.inf:
                    known = True
                else:
                    i, j = (i + 1, j) if x >= y else (i, j + 1)
                    continue
                break
            if len(self.pairs) >= PAIRS:
                self.pairs.clear()
            self.pairs[left, right] = known
        return known

    def apart(self, segment: str) -> tuple[int, ...]:
        """merged() of a segment, part by part."""
        joined, parts, at = self.joined, self.parts, 0
        ids: tuple[int, ...] = ()
        for end in [*[k for k in range(1, len(segment)) if segment[k - 1 : k + 1] not in joined], len(segment)]:
            part = segment[at:end]
            known = parts.get(part)
            if known is None:
                known = self.merged(part)
                if len(part) <= 64:
                    if len(parts) >= CACHE:
                        parts.clear()
                    parts[part] = known
            ids += known
            at = end
        return ids

    def merged(self, segment: str) -> tuple[int, ...]:
        """Ids that merging a segment, whose spaces are U+2581, in the model's order gives. Other characters than pieces have
        negative numbers until they are written as bytes."""
        n = len(segment)
        last: list[int | None] = [None] * (n + 1)
        start, fits, pairs = [0] * (n + 1), self.fits, self.pairs
        links = self.automaton.iter(segment)
        if not self.single.issuperset(segment):
            alone = [(end, (1, 0.0, -1 - ord(c))) for end, c in enumerate(segment) if c not in self.single]
            links = sorted([*links, *alone], key=lambda link: link[0])
        for end, (length, _, i) in links:
            end += 1
            if last[end] is None:
                at = end - length
                if at:
                    left = last[at]
                    known = pairs.get((left, i))
                    if known is None:
                        known = fits(left, i)
                    if not known:
                        continue
                last[end], start[end] = i, at
        ids: list[int] = []
        at = n
        while at:
            i = last[at]
            ids += [i] if i >= 0 else [self.bytes[b] for b in reversed(chr(-1 - i).encode())]
            at = start[at]
        return tuple(reversed(ids))

    def viterbi(self, segment: str) -> tuple[int, ...]:
        """Ids of the best segmentation of a segment whose spaces are U+2581; of equal scores the longest last piece wins."""
        n = len(segment)
        best, last, start = [0.0] + [-np.inf] * n, [-1] * (n + 1), [0] * (n + 1)
        if self.single.issuperset(segment):
            for end, (length, score, i) in self.automaton.iter(segment):
                total = best[end + 1 - length] + score
                if total > best[end + 1]:
                    best[end + 1], last[end + 1], start[end + 1] = total, i, end + 1 - length
        else:
            found: dict[int, list[tuple[int, float, int]]] = {}
            for end, piece in self.automaton.iter(segment):
                found.setdefault(end, []).append(piece)
            for end in range(n):
                for length, score, i in found.get(end, ()):
                    total = best[end + 1 - length] + score
                    if total > best[end + 1]:
                        best[end + 1], last[end + 1], start[end + 1] = total, i, end + 1 - length
                if segment[end] not in self.single and best[end] + self.fallback > best[end + 1]:
                    best[end + 1], last[end + 1], start[end + 1] = best[end] + self.fallback, -1, end
        ids: list[int] = []
        at = n
        while at:
            if last[at] < 0:
                ids += [self.bytes[b] for b in reversed(segment[start[at] : at].encode())]
            else:
                ids.append(last[at])
            at = start[at]
        return tuple(reversed(ids))

    def segment(self, segment: str) -> tuple[int, ...]:
        if SPACE not in segment:
            return self.best(segment.replace(" ", SPACE))
        # The text's own U+2581: bytes, with the segmentations of what stands between.
        own = tuple(self.bytes[b] for b in SPACE.encode())
        ids: tuple[int, ...] = ()
        for k, part in enumerate(segment.split(SPACE)):
            ids += (own if k else ()) + (self.best(part.replace(" ", SPACE)) if part else ())
        return ids

    def encode(self, text: str) -> list[int]:
        if not text:
            return []
        ids: list[int] = []
        seen = self.seen
        for x in self.cuts.findall(" " + text):
            known = seen.get(x)
            if known is None:
                known = self.segment(x)
                if len(x) <= 64:
                    if len(seen) >= CACHE:
                        seen.clear()
                    seen[x] = known
            ids += known
        return ids


def decode(ids: list[int], table: list[bytes]) -> str:
    """The text of ids; ``table`` is Pieces.decoded()."""
    return b"".join(map(table.__getitem__, ids)).decode("utf-8", "replace")[1:]


def _encoder(held):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = kept(held)
        pieces.encoder = encoder = pieces.encoder or Encoder(pieces)
        table = pieces.decoded()
        for batch in batches:
            ids, sizes, flat, same, held_bytes = [], [], [], [], 0
            for i in range(batch.num_rows):
                text = batch.column(1)[i].as_py() or ""
                own = encoder.encode(text)
                ids.append(batch.column(0)[i])
                same.append(decode(own, table) == text)
                sizes.append(len(own))
                flat.append(np.array(own, np.int32))
                held_bytes += len(text)
                if held_bytes > BATCH_BYTES or i + 1 == batch.num_rows:
                    at = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                    lists = pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate(flat)))
                    yield pa.RecordBatch.from_arrays([pa.array([x.as_py() for x in ids], pa.int64()), lists, pa.array(sizes, pa.int64()), pa.array(same, pa.bool_())], names=["doc_id", "ids", "n_tokens", "round_trip"])
                    ids, sizes, flat, same, held_bytes = [], [], [], [], 0

    return run


def encode(docs: DataFrame, path: str = MODEL) -> DataFrame:
    """One row per row of ``docs``: doc_id, ids, n_tokens, and round_trip: whether decoding gives the text again."""
    held = send(docs.sparkSession, Pieces(path))
    return map_texts(docs.select("doc_id", "text"), _encoder(held), "doc_id long, ids array<int>, n_tokens long, round_trip boolean")


def decode_table(encoded: DataFrame, path: str = MODEL) -> DataFrame:
    """(doc_id, text) of encode()'s rows."""
    held = send(encoded.sparkSession, Pieces(path).decoded())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = received(held)
        for batch in batches:
            texts = [decode(x.as_py() or [], table) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", F.col("ids")).mapInArrow(run, "doc_id long, text string")
