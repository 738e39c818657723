"""Merge-type SentencePiece encoding and decoding with a score-ordered agenda (op 8).

Nulls count as empty texts; an empty text has no ids and decodes to ''. Repeated rows,
clashing extra columns and texts of any length are allowed: the work is per row.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from sparkloom.llm.common import by_size

SPACE = "▁"
NEVER = float("inf")


class MergeVocabulary:
    """Pieces and scores of one model file whose type is merge (BPE) with byte fallback."""

    def __init__(self, model_path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(model_path, "rb") as f:
            model.ParseFromString(f.read())
        norm, train = model.normalizer_spec, model.trainer_spec
        if train.model_type != 2 or norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.escape_whitespaces:
            raise ValueError("only merge-type models with identity normalization are supported")
        if any(p.type not in (1, 2, 3, 6) for p in model.pieces):
            raise ValueError("user-defined and unused pieces are not supported")
        self.pieces = {p.piece: (p.score, i) for i, p in enumerate(model.pieces) if p.type == 1}
        self.cost = {p: -score for p, (score, _) in self.pieces.items()}.get
        if any(SPACE in p.lstrip(SPACE) for p in self.pieces):
            raise ValueError("pieces that run across a word start are not supported")
        self.plain_ids = {i for _, i in self.pieces.values()}
        self.byte_ids = {int(p.piece[3:5], 16): i for i, p in enumerate(model.pieces) if p.type == 6}
        self.unknown = next(i for i, p in enumerate(model.pieces) if p.type == 2)
        if any("\n" in p for p in self.pieces):
            raise ValueError("pieces with a line break are not supported")
        self.dummy_prefix = norm.add_dummy_prefix
        self.library = sentencepiece.SentencePieceProcessor(model_file=model_path)

    def merge(self, symbols: str) -> list[int]:
        """Ids of one stretch of symbols: best score first, leftmost on ties, until nothing merges."""
        ids: list[int] = []
        for part in self.short(symbols) if len(symbols) <= 24 else self.long(symbols):
            found = self.pieces.get(part)
            if found:
                ids.append(found[1])
            elif self.byte_ids:
                ids.extend([self.byte_ids[b] for b in part.encode()])
            else:
                ids.append(self.unknown)
        return ids

    def ids_of(self, word: str) -> list[int]:
        """Ids of a word behind a space; one that begins with a line break follows it without a space."""
        if word[:1] == "\n":
            return self.merge("\n") + (self.merge(word[1:]) if len(word) > 1 else [])
        return self.merge(SPACE + word)

    def whole(self, text: str) -> list[int]:
        """Ids of a whole text, one run of the marker and what follows after the other."""
        ids: list[int] = []
        symbols = (SPACE if self.dummy_prefix else "") + text.replace(" ", SPACE)
        start = 0
        for i in range(1, len(symbols) + 1):
            if i == len(symbols) or (symbols[i] == SPACE and symbols[i - 1] != SPACE):
                ids += self.merge(symbols[start:i])
                start = i
        return ids

    def short(self, symbols: str) -> list[str]:
        """The agenda as a flat list of pair costs: cheapest for the few symbols of a word."""
        cost, never = self.cost, NEVER
        parts = list(symbols)
        agenda = [cost(symbols[i : i + 2], never) for i in range(len(parts) - 1)]
        while agenda:
            best = min(agenda)
            if best == never:
                break
            i = agenda.index(best)
            parts[i] += parts.pop(i + 1)
            del agenda[i]
            if i < len(agenda):
                agenda[i] = cost(parts[i] + parts[i + 1], never)
            if i:
                agenda[i - 1] = cost(parts[i - 1] + parts[i], never)
        return parts

    def long(self, symbols: str) -> list[str]:
        """The agenda as a heap with a linked list of symbols: n log n for long stretches."""
        n, pieces = len(symbols), self.pieces
        parts: list[str | None] = list(symbols)
        left, right = list(range(-1, n - 1)), [*range(1, n), -1]
        agenda = []
        for i in range(n - 1):
            found = pieces.get(symbols[i : i + 2])
            if found:
                agenda.append((-found[0], i, i + 1, symbols[i : i + 2]))
        heapq.heapify(agenda)
        while agenda:
            _, i, j, joined = heapq.heappop(agenda)
            if parts[i] is None or parts[j] is None or right[i] != j or len(parts[i]) + len(parts[j]) != len(joined):
                continue
            parts[i], parts[j] = joined, None
            k = right[i] = right[j]
            if k >= 0:
                left[k] = i
                found = pieces.get(joined + parts[k])
                if found:
                    heapq.heappush(agenda, (-found[0], i, k, joined + parts[k]))
            h = left[i]
            if h >= 0:
                found = pieces.get(parts[h] + joined)
                if found:
                    heapq.heappush(agenda, (-found[0], h, i, parts[h] + joined))
        return [part for part in parts if part is not None]


class Lockstep:
    """The agenda of many words of one length at a time: a row of pair costs each, of which the least is merged, the leftmost on ties."""

    def __init__(self, vocabulary: MergeVocabulary):
        pieces = vocabulary.pieces
        self.many = 1 + max((i for _, i in pieces.values()), default=0)
        number = {p: i for p, (_, i) in pieces.items()}
        for c in sorted({c for p in pieces for c in p}.difference(number)):  # symbols that are no pieces of their own
            number[c] = self.many + len(number)
        pairs = {}
        for piece, (score, i) in pieces.items():
            for at in range(1, len(piece)):
                a, b = number.get(piece[:at]), number.get(piece[at:])
                if a is not None and b is not None:
                    pairs[a << 32 | b] = (-score, i)
        self.keys = np.array(sorted(pairs) or [-1], np.int64)
        self.costs = np.array([pairs[k][0] for k in self.keys.tolist() if k in pairs] or [NEVER])
        self.merged = np.array([pairs[k][1] for k in self.keys.tolist() if k in pairs] or [0], np.int64)
        symbols = sorted((ord(c), n) for c, n in number.items() if len(c) == 1)
        self.points, self.numbers = np.array([x[0] for x in symbols] or [0]), np.array([x[1] for x in symbols] or [-1])

    def look_up(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cost and piece of pairs of symbols; a pair that makes no piece costs infinity."""
        key = a << 32 | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        fits = (self.keys[at] == key) & (a >= 0) & (b >= 0)
        return np.where(fits, self.costs[at], NEVER), self.merged[at]

    def merge(self, words: list[str]) -> list[list[int] | None]:
        """Ids of stretches of one length; None where a symbol is no piece."""
        length = len(words[0])
        points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64).reshape(-1, length)
        at = np.minimum(np.searchsorted(self.points, points), len(self.points) - 1)
        symbols = np.where(self.points[at] == points, self.numbers[at], -1)
        out: list[list[int] | None] = [None] * len(words)
        own, columns = np.arange(len(words)), np.arange(length)
        cost, made = self.look_up(symbols[:, :-1], symbols[:, 1:])
        sizes = np.full(len(words), length)
        while True:
            best = cost.argmin(1) if cost.shape[1] else np.zeros(len(own), np.int64)
            row = np.arange(len(own))
            going = cost[row, best] < NEVER if cost.shape[1] else np.zeros(len(own), bool)
            ended = symbols[~going]
            plain = ((ended >= 0) & (ended < self.many) | (columns >= sizes[~going, None])).all(1)
            for i, fine, row_sizes, found in zip(own[~going].tolist(), plain.tolist(), sizes[~going].tolist(), ended.tolist(), strict=True):
                if fine:
                    out[i] = found[:row_sizes]
            if not going.any():
                return out
            if not going.all():
                own, symbols, cost, made, sizes, best = (x[going] for x in (own, symbols, cost, made, sizes, best))
                row = np.arange(len(own))
            symbols[row, best] = made[row, best]
            behind = columns[None, :-1] > best[:, None]
            symbols[:, :-1] = np.where(behind, symbols[:, 1:], symbols[:, :-1])
            symbols[:, -1] = -1
            cost[:, :-1] = np.where(behind[:, :-1], cost[:, 1:], cost[:, :-1])
            made[:, :-1] = np.where(behind[:, :-1], made[:, 1:], made[:, :-1])
            cost[:, -1] = NEVER
            sizes -= 1
            cost[row, best], made[row, best] = self.look_up(symbols[row, best], symbols[row, np.minimum(best + 1, length - 1)])
            left = best > 0
            r, at = row[left], best[left]
            cost[r, at - 1], made[r, at - 1] = self.look_up(symbols[r, at - 1], symbols[r, at])


class WordCache:
    """Words to their comma-joined ids; bounded, so long runs keep their memory. Serves all tasks of a worker process.

    A word is the text between two spaces, which stands for one run of the marker and
    what follows: no piece has the marker behind another symbol, so merges never cross it.
    A line break ends a word too, as no piece holds one.
    Each word that is met for the first time is also encoded by the library, in one call per Arrow batch (one behind a
    line break with a letter before the break), and so are whole texts that aren't taken word by word.
    Words of plain pieces decode to themselves; of others (with byte or unknown pieces) the library tells. A text whose
    words all do so decodes to itself; others are decoded by the library.
    """

    MOST, LONGEST, SHORT = 400_000, 80, 24
    #: Characters of the texts that are taken together.
    CHARACTERS = 4_000_000
    shared: dict[str, WordCache] = {}

    def __init__(self, vocabulary: MergeVocabulary):
        self.vocabulary, self.lockstep = vocabulary, Lockstep(vocabulary)
        self.known: dict[str, str] = {}
        self.odd: set[str] = set()

    @classmethod
    def of(cls, model_path: str) -> WordCache:
        if model_path not in cls.shared:
            cls.shared[model_path] = cls(MergeVocabulary(model_path))
        return cls.shared[model_path]

    def learn(self, words: list[str]) -> list[str]:
        """Comma-joined ids of different words; new ones are verified."""
        if len(self.known) > self.MOST:
            self.known.clear()
            self.odd.clear()
        out = list(map(self.known.get, words))
        new = [w for w, ids in zip(words, out, strict=True) if ids is None]
        ids = self.ids_of(new)
        self.verify(new, ids)
        fresh = {w: ",".join(map(str, i)) for w, i in zip(new, ids, strict=True)}
        self.known.update((w, i) for w, i in fresh.items() if len(w) <= self.LONGEST)
        return [fresh[w] if i is None else i for w, i in zip(words, out, strict=True)]

    def ids_of(self, words: list[str]) -> list[list[int]]:
        """Ids of words behind a space; one that begins with a line break follows it without a space."""
        by_length: dict[int, list[int]] = {}
        for i, w in enumerate(words):
            if w[:1] != "\n" and len(w) < self.SHORT:
                by_length.setdefault(len(w), []).append(i)
        out: list[list[int] | None] = [None] * len(words)
        for places in by_length.values():
            for i, found in zip(places, self.lockstep.merge([SPACE + words[i] for i in places]), strict=True):
                out[i] = found
        alone = [i for i, found in enumerate(out) if found is None]
        for i in alone:
            out[i] = self.vocabulary.ids_of(words[i])
        unusual = [i for i in alone if not self.vocabulary.plain_ids.issuperset(out[i])]
        decoded = self.vocabulary.library.decode([out[i] for i in unusual], num_threads=1) if unusual else []
        self.odd.update(words[i] for i, text in zip(unusual, decoded, strict=True) if text != words[i])
        return out

    def verify(self, words: list[str], ids: list[list[int]]) -> None:
        """Compare words with the library."""
        library = self.vocabulary.library
        before = library.encode("x")
        for word, own, theirs in zip(words, ids, library.encode(["x" + w if w[:1] == "\n" else w for w in words], num_threads=1), strict=True):
            if word and theirs != (before + own if word[0] == "\n" else own):
                raise ValueError(f"encoding differs from the library for {word[:80]!r}")

    def encode(self, texts: list[str]) -> tuple[list[str], list[str]]:
        """Comma-joined ids of whole texts, and the texts that they decode to."""
        texts = [t.replace(SPACE, " ") if SPACE in t else t for t in texts]  # the marker itself stands for a space
        ids, decoded = [""] * len(texts), list(texts)
        by_word = [i for i, t in enumerate(texts) if t and self.vocabulary.dummy_prefix and not ("  " in t or " \n" in t or t[0] in " \n" or t[-1] == " ")]
        if by_word:
            ready = [texts[i].replace("\n", " \n") for i in by_word]
            words = pc.split_pattern(pa.array([" ".join(ready)], pa.large_string()), " ").values.dictionary_encode()
            different = words.dictionary.to_pylist()
            found = pa.array(self.learn(different), pa.large_string()).take(words.indices)
            stops = np.cumsum([t.count(" ") + 1 for t in ready])
            lists = pa.LargeListArray.from_arrays(pa.array([0, *stops.tolist()], pa.int64()), found)
            for i, joined in zip(by_word, pc.binary_join(lists, pa.scalar(",", pa.large_string())).to_pylist(), strict=True):
                ids[i] = joined
            odd = [code for code, w in enumerate(different) if w in self.odd] if self.odd else []
            for j in np.unique(np.searchsorted(stops, np.flatnonzero(np.isin(words.indices.to_numpy(), odd)), "right")).tolist() if odd else []:
                decoded[by_word[j]] = self.vocabulary.library.decode([int(x) for x in ids[by_word[j]].split(",")])
        taken = set(by_word)
        whole = [i for i, t in enumerate(texts) if t and i not in taken]
        own = [self.vocabulary.whole(texts[i]) for i in whole]
        if whole and self.vocabulary.library.encode([texts[i] for i in whole], num_threads=1) != own:
            raise ValueError("encoding of whole texts differs from the library")
        for i, found in zip(whole, own, strict=True):
            ids[i], decoded[i] = ",".join(map(str, found)), self.vocabulary.library.decode(found)
        return ids, decoded


def encode_decode(docs: DataFrame, model_path: str, text_column: str = "text", id_column: str = "doc_id") -> DataFrame:
    """Ids (comma-joined) and decoded text of every row, as ``(id, ids, n_tokens, decoded)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordCache.of(model_path)
        for batch in by_size(batches, 1, words.CHARACTERS):
            ids, decoded = words.encode([x or "" for x in batch.column(1).to_pylist()])
            counts = [x.count(",") + 1 if x else 0 for x in ids]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.string()), pa.array(counts, pa.int64()), pa.array(decoded, pa.string())], names=[id_column, "ids", "n_tokens", "decoded"])

    kind = docs.schema[id_column].dataType.simpleString()
    return docs.select(id_column, text_column).mapInArrow(run, f"{id_column} {kind}, ids string, n_tokens bigint, decoded string")


def digests(encoded: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """The contract's columns from :func:`encode_decode`'s output."""
    from pyspark.sql import functions as F

    return encoded.select(id_column, "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
