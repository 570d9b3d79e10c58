"""SentencePiece encoding and decoding by streaming Viterbi.

The forward pass keeps, for each place, the last piece of the one segmentation of the text up to there that the merge order of a BPE
vocabulary allows: a piece may follow another only if the two, merged alone, stay those two pieces, and exactly one last piece fits each
place. A piece reaches over at most the longest piece's length, so the paths that can still go on are those that end within that
length of the front. A long text is stepped through in blocks: the block and a ring of that length before it are all the text that is
looked at. After each block the open paths are followed back until they meet; ids up to there are committed and forgotten. Where
paths do not meet (a run of one letter) the backpointers of the block, four bytes a place, are set aside until they do or the text
ends, and the window stays as it is. Within a block, stretches between places that no piece reaches across are stepped through
side by side; texts shorter than a block share one. No result is taken from a memory of texts or words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from dockgrid.llm.common import ODD, arrow, rows

SPACE = "▁"
#: Stands between texts: no character, so no piece holds it.
BORDER = 0x110000
OUT = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("n_ids", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string()), ("round_trip", pa.bool_())])
OUT_SQL = "doc_id long, ids array<int>, n_ids long, ids_sha256 string, decoded_sha256 string, round_trip boolean"


class Exact:
    """An array-wise lookup of 64-bit keys: values of keys that are there, -1 for others."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.levels = []
        while len(keys):
            bits = max(4, int(4 * len(keys)).bit_length())
            slot = self._slot(keys, len(self.levels), bits)
            _, at = np.unique(slot, return_index=True)
            there, held = np.full(1 << bits, -1, np.int64), np.full(1 << bits, -1, np.int32)
            there[slot[at]], held[slot[at]] = keys[at], values[at]
            self.levels.append((bits, there, held))
            rest = np.ones(len(keys), bool)
            rest[at] = False
            keys, values = keys[rest], values[rest]

    @staticmethod
    def _slot(keys: np.ndarray, level: int, bits: int) -> np.ndarray:
        return ((keys.astype(np.uint64) + np.uint64(level)) * ODD >> np.uint64(64 - bits)).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        out = np.full(len(keys), -1, np.int32)
        left = None
        for level, (bits, there, held) in enumerate(self.levels):
            mine = keys if left is None else keys[left]
            slot = self._slot(mine, level, bits)
            found = there[slot]
            hit = found == mine
            if left is None:
                np.copyto(out, held[slot], where=hit)
                left = np.flatnonzero(~hit & (found >= 0))
            else:
                out[left[hit]] = held[slot[hit]]
                left = left[~hit & (found >= 0)]
            if not len(left):
                break
        return out


class Codec:
    """Of a BPE vocabulary with byte fallback, space marks as white space and a space mark put before each text."""

    #: Characters of short texts that share a window, and of a long text's blocks; places of a stretch that are stepped through side by
    #: side with those of others.
    WINDOW, BLOCK, ABREAST = 60_000, 16_384, 256
    PAIR_BITS = 21

    def __init__(self, pieces: dict[str, tuple[int, float]], byte_ids: list[int]):
        self.rank = {p: s for p, (_, s) in pieces.items()}
        self.byte_ids = np.array(byte_ids, np.int32)
        self.text = {i: p.encode() for p, (i, _) in pieces.items()} | {i: bytes([b]) for b, i in enumerate(byte_ids)}
        self.longest = max(map(len, pieces))
        # Symbols: the pieces, characters that only occur within pieces, and one for all other characters.
        self.names = [*pieces, *sorted({c for p in pieces for c in p} - set(pieces)), ""]
        self.other = len(self.names) - 1
        self.size = np.array([len(x) or 1 for x in self.names], np.int32)
        self.ids = np.array([pieces[x][0] if x in pieces else -1 for x in self.names], np.int32)
        self.histories: dict[str, list[tuple[float, str, str]] | None] = {}
        self._trie()
        self.pair_keys = np.full(1 << self.PAIR_BITS, -1, np.int64)
        self.pair_fits = np.zeros(1 << self.PAIR_BITS, bool)

    def _trie(self) -> None:
        steps: dict[int, int] = {}
        symbol = [-1]  # of the node's string, as a piece
        for k, name in enumerate(self.names[:-1]):
            node = 0
            for c in name:
                key = (node << 21) | ord(c)
                node = steps.setdefault(key, len(symbol))
                if node == len(symbol):
                    symbol.append(-1)
            symbol[node] = k
        self.steps = Exact(np.fromiter(steps.keys(), np.int64, len(steps)), np.fromiter(steps.values(), np.int32, len(steps)))
        self.symbol = np.array(symbol, np.int32)
        self.whole = np.array([s >= 0 and self.history(self.names[s]) is not None for s in symbol])

    @staticmethod
    @cache
    def load(path: str) -> Codec:
        from sentencepiece import SentencePieceProcessor

        sp = SentencePieceProcessor(model_file=path)
        n = range(sp.get_piece_size())
        plain = {sp.id_to_piece(i): (i, sp.get_score(i)) for i in n if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))}
        return Codec(plain, [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)])

    def history(self, piece: str) -> list[tuple[float, str, str]] | None:
        """How a piece alone is merged, best scored neighbouring pair first, the left of equals: (score, first part, last part) after
        each merge. None if it does not end as one piece. Of pieces and single characters, so their number is bounded."""
        if piece in self.histories:
            return self.histories[piece]
        parts, out = list(piece), [(float("inf"), piece[:1], piece[-1:])]
        while len(parts) > 1:
            scores = [self.rank.get(a + b, -float("inf")) for a, b in zip(parts, parts[1:], strict=False)]
            best = max(scores)
            if best == -float("inf"):
                out = None
                break
            k = scores.index(best)
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
            out.append((best, parts[0], parts[-1]))
        self.histories[piece] = out
        return out

    def follows(self, a: str, b: str) -> bool:
        """Whether a and b stay apart when merged together: no pair across their border is ever the best one."""
        left, right = self.history(a), self.history(b)
        i = j = 0
        lowest = -float("inf")
        while True:
            across = self.rank.get(left[i][2] + right[j][1], lowest) if a and b else lowest
            s = left[i + 1][0] if i + 1 < len(left) else lowest
            t = right[j + 1][0] if j + 1 < len(right) else lowest
            if across > s and across >= t and across > lowest:
                return False
            if s == t == lowest:
                return True
            if s >= t:
                i += 1
            else:
                j += 1

    def fit(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """follows() for arrays of symbols. Pairs of the vocabulary looked at lately are in a table of fixed size."""
        key = a.astype(np.int64) * len(self.names) + b
        slot = (key.astype(np.uint64) * ODD >> np.uint64(64 - self.PAIR_BITS)).astype(np.int64)
        out = self.pair_fits[slot]
        new = np.flatnonzero(self.pair_keys[slot] != key)
        if len(new):
            fresh, back = np.unique(key[new], return_inverse=True)
            n = len(self.names)
            got = np.array([self.follows(self.names[k // n], self.names[k % n]) for k in fresh.tolist()])
            out[new] = got[back]
            at = np.empty(len(fresh), np.int64)
            at[back] = slot[new]
            self.pair_keys[at], self.pair_fits[at] = fresh, got
        return out

    def lattice(self, c: np.ndarray):
        """Starts, ends and symbols of the pieces of two characters or more that the characters c hold, the symbols of single
        characters, and the places (0 to len(c)) that no piece reaches across."""
        n = len(c)
        node = self.steps.get(c.astype(np.int64))  # the root is node 0
        single = np.where(node >= 0, self.symbol[node], self.other)
        across = np.zeros(n + 2, np.int32)
        at = np.flatnonzero(node >= 0)
        node = node[at]
        found = []
        for size in range(2, self.longest + 1):
            inside = at + size <= n
            at, node = at[inside], node[inside]
            node = self.steps.get((node.astype(np.int64) << 21) | c[at + size - 1])
            ok = node >= 0
            at, node = at[ok], node[ok]
            if not len(at):
                break
            piece = self.symbol[node] >= 0
            across[at[piece] + 1] += 1
            across[at[piece] + size] -= 1
            piece &= self.whole[node]
            found.append((at[piece], at[piece] + size, self.symbol[node[piece]]))
        starts, ends, symbols = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 3
        return starts, ends, symbols, single, np.flatnonzero(np.cumsum(across[: n + 1]) == 0)

    def forward(self, starts, ends, symbols, single, meet, given: np.ndarray | None = None) -> np.ndarray:
        """The symbol that ends at each place (1 to n) in the one segmentation that fits up to there.

        given: those of the places from 0 on that are known already, of which there are as many as the longest piece has characters
        (the paths to them come from before c).
        """
        n = len(single)
        last = np.concatenate(([-1], single)).astype(np.int32)
        known = 0
        carried = False  # whether pieces reach across the last known place
        if given is not None:
            known = len(given) - 1
            last[: known + 1] = given
            new = ends > known
            starts, ends, symbols = starts[new], ends[new], symbols[new]
            meet = meet[meet >= known]
            if carried := not len(meet) or meet[0] != known:
                meet = np.concatenate(([known], meet))
        many = np.zeros(n + 1, bool)
        many[ends] = True
        base = np.concatenate((np.zeros(known + 1, np.int64), np.repeat(meet[:-1], np.diff(meet))))  # start of the place's stretch
        sure = starts == base[ends]  # a piece from the stretch's start is the one that fits
        heads = base[many.nonzero()[0]] + 1  # the first place of a stretch holds one character
        if carried:
            sure &= starts != known
            heads = heads[heads != known + 1]
        last[ends[sure]] = symbols[sure]
        many[ends[sure]] = False
        many[heads] = False
        open_ = np.flatnonzero(many)
        more = many[ends]
        s = np.concatenate((starts[more], open_ - 1))
        e = np.concatenate((ends[more], open_))
        x = np.concatenate((symbols[more], single[open_ - 1])).astype(np.int32)
        step = e - base[e]
        order = np.argsort(step.astype(np.uint16) if n < 1 << 16 else step, kind="stable")
        s, e, x, step = s[order], e[order], x[order], step[order]
        bounds = np.searchsorted(step, np.arange(1, self.ABREAST + 2))
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            if a < b:
                ok = self.fit(last[s[a:b]], x[a:b])
                last[e[a:b][ok]] = x[a:b][ok]
            elif a == len(s):
                break
        if bounds[-1] < len(s):  # stretches this long are few: one place after the other
            known_pairs: dict[tuple[int, int], bool] = {}
            for a, b, y in zip(s[bounds[-1] :].tolist(), e[bounds[-1] :].tolist(), x[bounds[-1] :].tolist(), strict=True):
                pair = (int(last[a]), y)
                if (fits := known_pairs.get(pair)) is None:
                    fits = known_pairs[pair] = self.follows(self.names[pair[0]], self.names[y])
                if fits:
                    last[b] = y
        return last

    def segments(self, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ends and symbols of the segmentation of c, the whole of some texts."""
        starts, ends, symbols, single, meet = self.lattice(c)
        last = self.forward(starts, ends, symbols, single, meet)
        taken = np.zeros(len(c) + 1, bool)
        at, low = meet[1:], meet[:-1]
        while len(at):
            taken[at] = True
            at = at - self.size[last[at]]
            on = at > low
            at, low = at[on], low[on]
        places = np.flatnonzero(taken)
        return places, last[places]

    def ids_of(self, c: np.ndarray, places: np.ndarray, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids, and the number of ids of each symbol: characters that are no pieces fall back to their bytes."""
        ids = self.ids[symbols]
        count = np.ones(len(ids), np.int64)
        bare = np.flatnonzero(ids < 0)
        if len(bare):
            code = c[places[bare] - 1]
            count[bare] = 1 + (code >= 0x80).astype(np.int64) + (code >= 0x800) + (code >= 0x10000)
            count[bare[code == BORDER]] = 0
            data = code[code != BORDER].astype("<u4").tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogatepass")
            own = np.repeat(ids < 0, count)
            ids = np.repeat(ids, count)
            ids[own] = self.byte_ids[np.frombuffer(data, np.uint8)]
        return ids, count

    @staticmethod
    def characters(text: str) -> np.ndarray:
        c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        c[c == 32] = ord(SPACE)
        return c

    def stream(self, text: str, block: int | None = None, watch=None) -> Iterator[np.ndarray]:
        """Ids of text, committed as far as all open paths have met. watch(characters looked at, places held back) is told of each block."""
        block = max(block or self.BLOCK, 2 * self.longest)
        text = SPACE + text
        front = done = 0  # the places up to which the forward pass and the ids have come
        given = None  # symbols of the ring's places
        held: list[tuple[int, np.ndarray, list[int]]] = []  # blocks not committed: first place, symbols of the places after it, their sizes
        came: list[set[int]] = []  # for each of them, the places before it through which open paths come
        while front < len(text):
            ring = len(given) - 1 if given is not None else 0
            c = self.characters(text[front - ring : front + block])
            last = self.forward(*self.lattice(c), given)
            held.append((front, last[ring + 1 :], self.size[last[ring + 1 :]].tolist()))
            came.append(set())
            front += len(c) - ring
            given = last[-self.longest - 1 :]
            place = front if front == len(text) else self.met(held, came, front)
            if watch:
                watch(len(c), front - done)
            if place > done:
                yield self.committed(text, held, done, place)
                while held and held[0][0] + len(held[0][1]) <= place:
                    del held[0], came[0]
                if held:
                    cut = place - held[0][0]
                    held[0] = (place, held[0][1][cut:], held[0][2][cut:])
                done = place

    def met(self, held: list[tuple[int, np.ndarray, list[int]]], came: list[set[int]], front: int) -> int:
        """The place at which the paths to the last places, as many as the longest piece has characters, have met.

        They are followed back block by block, and no further than where the same paths came through before.
        """
        paths = set(range(front - self.longest + 1, front + 1))
        for k in range(len(held) - 1, -1, -1):
            start, _, sizes = held[k]
            while len(paths) > 1 and (p := max(paths)) > start:
                paths.remove(p)
                paths.add(p - sizes[p - start - 1])
            if len(paths) == 1:
                return paths.pop()
            if came[k] == paths:
                break
            came[k] = set(paths)
        return held[0][0]

    def committed(self, text: str, held: list[tuple[int, np.ndarray, list[int]]], done: int, place: int) -> np.ndarray:
        """Ids of text from done to place."""
        at, ends, symbols = place, [], []
        for start, last, sizes in reversed(held):
            first = len(ends)
            while at > start:
                ends.append(at)
                at -= sizes[at - start - 1]
            symbols.append(last[np.array(ends[first:], np.int64) - start - 1])
        return self.ids_of(self.characters(text[done:place]), np.array(ends[::-1], np.int64) - done, np.concatenate(symbols)[::-1])[0]

    def encode_all(self, texts: list[str], block: int | None = None) -> list[np.ndarray]:
        """Ids of each text: short ones share windows, longer ones than a block are streamed."""
        most = max(self.WINDOW, block or self.BLOCK)
        out: list[np.ndarray] = [np.zeros(0, np.int32)] * len(texts)
        held: list[int] = []
        size = 0

        def flush() -> None:
            nonlocal size
            if held:
                c = self.characters("".join(f"{SPACE}{texts[k]}\0" for k in held))
                borders = np.cumsum([len(texts[k]) + 2 for k in held])
                c[borders - 1] = BORDER
                places, symbols = self.segments(c)
                ids, count = self.ids_of(c, places, symbols)
                total = np.concatenate(([0], np.cumsum(count)))
                ends = total[np.searchsorted(places, borders, side="right")]
                for k, a, b in zip(held, np.concatenate(([0], ends[:-1])).tolist(), ends.tolist(), strict=True):
                    out[k] = ids[a:b]
            held.clear()
            size = 0

        for k, text in enumerate(texts):
            if len(text) >= (block or self.BLOCK):
                out[k] = np.concatenate(list(self.stream(text, block)))
            elif text:
                if size + len(text) > most:
                    flush()
                held.append(k)
                size += len(text) + 2
        flush()
        return out

    def encode(self, text: str, block: int | None = None) -> list[int]:
        return self.encode_all([text], block)[0].tolist()

    def decode(self, ids: list[int]) -> str:
        data = b"".join(map(self.text.__getitem__, ids)).decode("utf-8", "replace").replace(SPACE, " ")
        return data[1:] if data.startswith(" ") else data


def sentencepiece(docs: DataFrame, path: str, with_ids: bool = True) -> DataFrame:
    """doc_id, ids array<int> (null unless with_ids), n_ids long, ids_sha256 (of the ids as 4 bytes each, low byte first), decoded_sha256, round_trip boolean.

    One row for each row of docs, repeated rows and null doc_ids too; other columns of docs are left out. path: a SentencePiece BPE
    model on every machine. Null text is empty and has no ids. Texts longer than a block are encoded block by block, with
    the same ids. round_trip: the decoded ids are the text (texts that hold the space mark itself come back with spaces).
    """

    def run(batches):
        codec = Codec.load(path)
        for held in rows(batches, 1 << 18):
            texts = [t or "" for _, t in held]
            out = []
            coded = codec.encode_all(texts)
            for (doc, _), text, ids in zip(held, texts, coded, strict=True):
                back = codec.decode(ids.tolist())
                out.append((doc, len(ids), hashlib.sha256(ids.astype("<i4").tobytes()).hexdigest(), hashlib.sha256(back.encode("utf-8", "surrogatepass")).hexdigest(), back == text))
            columns = dict(zip(("doc_id", "n_ids", "ids_sha256", "decoded_sha256", "round_trip"), zip(*out, strict=True), strict=True))
            bounds = np.concatenate(([0], np.cumsum([len(x) for x in coded])))
            columns["ids"] = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(np.concatenate(coded), pa.int32())) if with_ids else pa.nulls(len(held), OUT.field("ids").type)
            yield arrow(columns, OUT)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, OUT_SQL)
