"""SentencePiece encoding of merge-type vocabularies by a score-ordered agenda.

A text's symbols start as its characters.  An agenda holds every adjacent pair
whose concatenation is a piece, best score first and leftmost among equals;
the top pair is merged and its new neighbours join the agenda.  Symbols that
are no piece fall back to bytes.  No piece of such a vocabulary continues past
a word's end, so words are encoded on their own and remembered.

The new words of an Arrow batch are merged in lockstep: each row of a matrix is
the agenda of one word, and every step takes the best pair of every row.  Long
words, for which rows would be wasteful, have an agenda on a heap.  The
sentencepiece library encodes the new words too, and a difference stops the job.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from loomwright.llm.arrow import as_text, slices

SPACE = "▁"


class PieceEncoder:
    """Encoder and decoder for one vocabulary; lives in a Python worker."""

    #: Words remembered in each of two generations (short ones only); characters of a word merged in lockstep.
    remembered = 60_000
    short = 40

    def __init__(self, model_path: str, check: bool = True):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=model_path)
        size = self.library.vocab_size()
        plain = [i for i in range(size) if not (self.library.is_control(i) or self.library.is_byte(i) or self.library.is_unknown(i) or self.library.is_unused(i))]
        self.ids = {self.library.id_to_piece(i): i for i in plain}
        self.scores = {piece: self.library.get_score(i) for piece, i in self.ids.items()}
        self.bytes = [self.library.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.unknown = self.library.unk_id()
        self.fallback = self.library.is_byte(self.bytes[0])
        self.begin, self.end = (np.uint32([i]).astype("<u4").tobytes() for i in (self.library.bos_id(), self.library.eos_id()))
        crossing = [p for p in self.ids if SPACE in p.lstrip(SPACE)]
        if crossing or self.library.normalize("  ﬁ ") != f"{SPACE} {SPACE}ﬁ{SPACE}":
            raise ValueError("only vocabularies without normalisation, whose pieces end with the word, are supported")
        # A line end that is in no piece is a border too.
        self.line = "\n" if not any("\n" in p for p in self.ids) else ""
        self.words = re.compile(rf" +[^ {self.line}]*" + rf"|\n[^ {self.line}]*" * bool(self.line))
        self.line_id = np.array(self.agenda("\n"), "<u4").tobytes()
        self.check = check
        self._pair_table()
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def agenda(self, word: str) -> list[int]:
        """The ids of one word (with ``SPACE`` for spaces)."""
        symbols: list[str | None] = list(word)
        n = len(symbols)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        scores, heap = self.scores, []
        for left in range(n - 1):
            pair = symbols[left] + symbols[left + 1]
            if pair in scores:
                heap.append((-scores[pair], left, left + 1, pair))
        heapq.heapify(heap)
        while heap:
            _, left, right, pair = heapq.heappop(heap)
            if symbols[left] is None or symbols[right] is None or after[left] != right or symbols[left] + symbols[right] != pair:
                continue  # one of the two was merged since
            symbols[left], symbols[right] = pair, None
            after[left] = after[right]
            if after[left] >= 0:
                before[after[left]] = left
            for a, b in ((before[left], left), (left, after[left])):
                if a >= 0 and b >= 0 and (new := symbols[a] + symbols[b]) in scores:
                    heapq.heappush(heap, (-scores[new], a, b, new))
        out: list[int] = []
        for symbol in symbols:
            if symbol is None:
                continue
            if (found := self.ids.get(symbol)) is not None:
                out.append(found)
            elif self.fallback:
                out += [self.bytes[b] for b in symbol.encode()]
            else:
                out.append(self.unknown)
        return out

    def _pair_table(self) -> None:
        """Symbols are the pieces and the characters in them; pairs of symbols name the piece they make."""
        names = list(self.ids) + sorted({c for p in self.ids for c in p} - self.ids.keys())
        number = {name: i for i, name in enumerate(names)}
        self.piece = np.array([self.ids.get(name, -1) for name in names], np.int64)
        self.char = np.full(0x110000, -1, np.int32)
        for name in names:
            if len(name) == 1:
                self.char[ord(name)] = number[name]
        ranks = {score: i for i, score in enumerate(sorted(set(self.scores.values()), reverse=True))}
        numbers = (
            x
            for p in self.ids
            for k in range(1, len(p))
            if p[:k] in number and p[k:] in number
            for x in ((number[p[:k]] << 20) + number[p[k:]], ranks[self.scores[p]], number[p])
        )
        table = np.fromiter(numbers, np.int64).reshape(-1, 3)
        table = np.r_[table[table[:, 0].argsort()], [(1 << 62, 0, 0)]]
        self.pairs, self.rank, self.made = table[:, 0].copy(), table[:, 1].astype(np.int32), table[:, 2].astype(np.int32)

    def _pair(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rank of each pair (the largest integer: no piece) and the symbol it makes."""
        keys = (left.astype(np.int64) << 20) + right
        at = np.searchsorted(self.pairs, keys)
        ok = (self.pairs[at] == keys) & (left >= 0) & (right >= 0)
        return np.where(ok, self.rank[at], np.iinfo(np.int32).max), self.made[at]

    def lockstep(self, words: list[str]) -> list[bytes | None]:
        """The ids of short words; None where a symbol is no piece."""
        sizes = np.array([len(w) for w in words])
        symbols = self.char[np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)]
        width, n = int(sizes.max()), len(words)
        grid = np.full((n, width), -1, np.int32)
        grid[np.arange(width) < sizes[:, None]] = symbols
        odd = np.zeros(n, bool)
        odd[np.repeat(np.arange(n), sizes)[symbols < 0]] = True
        out, live = grid.copy(), np.arange(n)
        if width > 1:
            rank, made = self._pair(grid[:, :-1], grid[:, 1:])
            none = np.iinfo(np.int32).max
            columns = np.arange(width - 1)
            while True:
                best = rank.argmin(1)  # the leftmost of the best
                go = rank[np.arange(len(live)), best] < none
                if not go.all():
                    out[live[~go]] = grid[~go]
                    live, grid, rank, made, best = live[go], grid[go], rank[go], made[go], best[go]
                if not len(live):
                    break
                rows = np.arange(len(live))
                grid[rows, best] = made[rows, best]
                after = columns[None, :] > best[:, None]
                grid[:, :-1] = np.where(after, np.roll(grid, -1, 1)[:, :-1], grid[:, :-1])
                grid[:, -1] = -1
                shift = columns[None, :] >= best[:, None]
                rank = np.where(shift, np.roll(rank, -1, 1), rank)
                made = np.where(shift, np.roll(made, -1, 1), made)
                rank[:, -1] = none
                for at in (best - 1, best):
                    ok = (at >= 0) & (at < width - 1)
                    r, c = rows[ok], at[ok]
                    rank[r, c], made[r, c] = self._pair(grid[r, c], grid[r, c + 1])
        filled = out >= 0
        ids = np.where(filled, self.piece[out], 0)
        odd |= (ids < 0).any(1)
        ends = np.cumsum(filled.sum(1)) * 4
        flat = ids[filled].astype("<u4").tobytes()
        return [None if x else flat[a:b] for x, a, b in zip(odd.tolist(), np.r_[0, ends[:-1]].tolist(), ends.tolist(), strict=True)]

    def _learn(self, words: list[str]) -> dict[str, bytes]:
        """The ids of new words, which are remembered if they are short."""
        words.sort(key=len)
        marked = [w[w[0] == "\n" :].replace(" ", SPACE) for w in words]
        own: list[bytes | None] = [None] * len(words)
        start, step = 0, 4096
        while start < len(words) and len(words[start]) <= self.short:
            stop = start + step
            while stop > start + 1 and len(words[min(stop, len(words)) - 1]) > self.short:
                stop -= 1
            stop = min(stop, len(words))
            own[start:stop] = self.lockstep(marked[start:stop])
            start = stop
        for i, ids in enumerate(own):
            if ids is None:
                own[i] = np.array(self.agenda(marked[i]), "<u4").tobytes()
            if words[i][0] == "\n":
                own[i] = self.line_id + own[i]
        if self.check:
            # Words joined again give their ids in turn (all but spaces alone, which the
            # next word would take up).  The library puts a space before a text, in place
            # of that of its first word; before a line end it is an id of its own.
            both = [(w, x) for w, x in zip(words, own, strict=True) if w.strip(" ")]
            runs = [both[i : i + 64] for i in range(0, len(both), 64)]
            texts = ["".join(w for w, _ in run) for run in runs]
            theirs = self.library.encode([t[1:] if t[0] == " " else t for t in texts], num_threads=1)
            for run, t, ids in zip(runs, texts, theirs, strict=True):
                if np.array(ids[t[0] != " " :], "<u4").tobytes() != b"".join(x for _, x in run):
                    raise AssertionError("a word's ids differ from the library's")
        learnt = dict(zip(words, own, strict=True))
        for word, ids in learnt.items():
            if len(word) > self.short:
                break
            if len(self.young) >= self.remembered:
                self.old, self.young = self.young, {}
            self.young[word] = ids
        return learnt

    def _look_up(self, words: list[str]) -> list[bytes]:
        """The ids of distinct words."""
        young, old = self.young, self.old
        found = [young.get(w) or old.get(w) for w in words]
        if new := [w for w, x in zip(words, found, strict=True) if x is None]:
            get = self._learn(new).get
            found = [x if x is not None else get(w) for w, x in zip(words, found, strict=True)]
        return found

    def encode(self, texts: pa.Array) -> list[bytes]:
        """Ids with begin and end, as little-endian unsigned 32-bit integers."""
        # Texts whose words are parted by single spaces or line ends are split by Arrow.
        odd = pc.match_substring_regex(texts, f"^ |  | \n| $|^$|{SPACE}" if self.line else "").to_numpy(zero_copy_only=False)
        even = texts.filter(pa.array(~odd))
        out: list[bytes] = [b""] * len(texts)
        if len(even):
            split = pc.split_pattern(pc.replace_substring(even, "\n", " \n"), " ")
            coded = split.flatten().dictionary_encode()
            ids = self._look_up([w if w[:1] == "\n" else " " + w for w in coded.dictionary.to_pylist()])
            sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
            flat = np.frombuffer(b"".join(ids), "<u4")
            starts = np.cumsum(sizes) - sizes
            tokens = coded.indices.to_numpy()
            size, upto = sizes[tokens], np.cumsum(sizes[tokens])
            gathered = flat[np.repeat(starts[tokens] - (upto - size), size) + np.arange(upto[-1])].tobytes()
            ends = 4 * upto[split.offsets.to_numpy()[1:] - split.offsets[0].as_py() - 1]
            for row, a, b in zip(np.flatnonzero(~odd).tolist(), np.r_[0, ends[:-1]].tolist(), ends.tolist(), strict=True):
                out[row] = self.begin + gathered[a:b] + self.end
        for row in np.flatnonzero(odd).tolist():
            text = texts[row].as_py()
            # An empty text gets no leading space.
            words = self.words.findall(" " + text.replace(SPACE, " ")) if text else []
            distinct = list(dict.fromkeys(words))
            known = dict(zip(distinct, self._look_up(distinct), strict=True))
            out[row] = self.begin + b"".join(map(known.__getitem__, words)) + self.end
        return out

    def decode(self, ids: list[bytes]) -> list[str]:
        return self.library.decode([np.frombuffer(x, "<u4").tolist() for x in ids], num_threads=1)


_encoders: dict[tuple[str, bool], PieceEncoder] = {}


def encoder(model_path: str, check: bool = True) -> PieceEncoder:
    if (model_path, check) not in _encoders:
        _encoders[model_path, check] = PieceEncoder(model_path, check)
    return _encoders[model_path, check]


def encode_pieces(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", check: bool = True) -> DataFrame:
    """One row for each row of ``docs``: id, ids, n_tokens, decoded.

    ``ids`` (binary) holds all ids with begin and end, little-endian unsigned
    32-bit; ``decoded`` is the library's decode of them.  ``model_path`` must
    be readable on every executor (a path of an installed package or of a file
    sent with ``addFile``).  Null text counts as empty, which is begin and end
    alone.  Texts of any length are encoded whole.  Repeated rows are encoded
    each; other columns aren't read.  An empty table gives an empty result.
    """
    rows = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(model_path, check)
        for batch in batches:
            for part in slices(batch, "text"):
                ids = own.encode(as_text(part.column("text")))
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(ids, pa.binary()), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(own.decode(ids), pa.string())],
                    ["id", "ids", "n_tokens", "decoded"],
                )

    return rows.mapInArrow(work, f"id {kind}, ids binary, n_tokens long, decoded string").withColumnRenamed("id", id_col)
