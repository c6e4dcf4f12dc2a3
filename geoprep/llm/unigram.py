"""Operator 10: SentencePiece unigram encoding and decoding.

The pieces of the model file and their scores (taken as log scores) are laid out once on
the driver as a double-array trie over UTF-8 bytes (``base``, ``check``, ``value``), whose
size is that of the vocabulary, and broadcast.  A pre-token is segmented by Viterbi: from
each character start the trie gives all pieces that begin there, and the best-scored path
wins; ties keep the path found first (earlier start, so the longer last piece).  A
character without a piece costs ``min score - 10`` and is written as its UTF-8 byte pieces
(or the unknown id, if the model has none).  Pre-tokens are independent (see ``pieces``),
so each distinct one is segmented once a worker (a bounded cache).

Decoding joins the pieces, turns runs of byte pieces into UTF-8 (invalid bytes become
U+FFFD), writes ``▁`` as a space and drops the dummy prefix.  ``decode(encode(text))`` is
the text itself, except that a literal ``▁`` comes back as a space, as in the library.

A null or empty text has no ids and decodes to the empty text.  Rows are handled alone, so
repeated rows and other columns do not matter; an empty table gives an empty result.
"""

from __future__ import annotations

from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices
from .pieces import MARK, check_vocabulary, pre_tokens

UNKNOWN_PENALTY = 10.0          # fixed value of the format: below the lowest score
_WORKER: dict = {}


class DoubleArray:
    """A double-array trie over bytes: the child of state s by byte c is base[s] + c + 1,
    valid if check[] of it is s; value[s] is the piece's id or -1."""

    def __init__(self, keys: list[bytes], ids: list[int]):
        children: list[dict] = [{}]
        value = [-1]
        for key, i in zip(keys, ids):
            node = 0
            for c in key:
                nxt = children[node].get(c)
                if nxt is None:
                    nxt = children[node][c] = len(children)
                    children.append({})
                    value.append(-1)
                node = nxt
            value[node] = i
        free = np.ones(2 * len(children) + 4096, bool)
        base, check = np.full(len(free), -1, np.int32), np.full(len(free), -1, np.int32)
        values = np.full(len(free), -1, np.int32)
        free[:257] = False                                   # so that a base is never negative
        first, todo, window = 257, [(0, 0)], 2048
        while todo:
            node, state = todo.pop()
            values[state] = value[node]
            if not children[node]:
                continue
            codes = np.fromiter(children[node], np.int64) + 1
            while not free[first]:
                first += 1
            b = first - int(codes.min())
            while len(codes) > 1:                            # the first place where all codes are free
                while b + window + 257 >= len(free):
                    free = np.concatenate([free, np.ones(len(free), bool)])
                    base, check, values = (np.concatenate([a, np.full(len(a), -1, np.int32)]) for a in (base, check, values))
                fits = np.logical_and.reduce([free[b + c:b + c + window] for c in codes])
                if fits.any():
                    b += int(fits.argmax())
                    break
                b += window
            base[state] = b
            check[b + codes] = state
            free[b + codes] = False
            todo += [(child, b + c + 1) for c, child in children[node].items()]
            if first + 600 >= len(free):
                free = np.concatenate([free, np.ones(len(free), bool)])
                base, check, values = (np.concatenate([a, np.full(len(a), -1, np.int32)]) for a in (base, check, values))
        last = int(np.flatnonzero(check >= 0).max(initial=0)) + 258
        self.base, self.check, self.value = base[:last], check[:last], values[:last]
        short = last - len(self.check)
        if short > 0:
            self.base, self.check, self.value = (np.concatenate([a, np.full(short, -1, np.int32)])
                                                 for a in (self.base, self.check, self.value))


class Unigram:
    """Segmentation with a trie, scores and the special ids; picklable."""

    def __init__(self, pieces: list[str], scores: list[float], ids: list[int], unk: int, byte_ids: list[int] | None):
        self.unk_score = min(scores, default=0.0) - UNKNOWN_PENALTY
        if byte_ids:            # an ASCII character without a piece is its byte piece at the unknown's score
            bare = [c for c in range(128) if chr(c) not in set(pieces)]
            pieces, ids = pieces + [chr(c) for c in bare], ids + [byte_ids[c] for c in bare]
            scores = scores + [self.unk_score] * len(bare)
        trie = DoubleArray([p.encode() for p in pieces], ids)
        self.base, self.check, self.value = trie.base, trie.check, trie.value
        self.score = np.full(max(ids, default=0) + 1, -np.inf)
        self.score[ids] = scores
        self.unk, self.byte_ids = unk, byte_ids

    def segment(self, words: list[str], batch: int = 1 << 15, wide: int = 1 << 20) -> list[bytes]:
        """Ids (int32 bytes) of each pre-token (written with its marks).  Words of like length share a
        batch, and one step of the search runs over the whole batch."""
        raw = [w.encode() for w in words]
        order = sorted(range(len(raw)), key=lambda i: len(raw[i]))
        out: list = [None] * len(raw)
        start = 0
        while start < len(order):
            end = min(len(order), start + batch)
            while end > start + 1 and (end - start) * len(raw[order[end - 1]]) > wide:
                end = start + (end - start) // 2
            part = order[start:end]
            for i, ids in zip(part, self._segment([raw[i] for i in part])):
                out[i] = ids
            start = end
        return out

    def _segment(self, raw: list[bytes]) -> list[bytes]:
        lens = np.array([len(b) for b in raw])
        n, width = len(raw), int(lens.max(initial=0))
        flat = np.frombuffer(b"".join(b.ljust(width, b"\0") for b in raw), np.uint8)
        text = np.ascontiguousarray(flat.reshape(n, width).T).astype(np.int32)
        best = np.full((width + 1, n), -np.inf)
        best[0] = 0.0
        start_of, piece_at = np.zeros((width + 1, n), np.int32), np.full((width + 1, n), -1, np.int32)

        def reach(j, who, i, piece, s):
            better = s > best[j, who]
            j, who = (x[better] if isinstance(x, np.ndarray) else x for x in (j, who))
            best[j, who], start_of[j, who] = s[better], i
            piece_at[j, who] = piece[better] if isinstance(piece, np.ndarray) else piece

        for i in range(width):
            lead = text[i]
            who = np.flatnonzero((lens > i) & ((lead & 0xC0) != 0x80))
            chars = 1 + (lead >= 0xC0) + (lead >= 0xE0) + (lead >= 0xF0)     # bytes of the character
            alone = np.ones(n, bool)                                         # it is no piece itself
            active, state, j = who, np.zeros(len(who), np.int32), i
            while len(active) and j < width:
                nxt = self.base[state] + text[j, active] + 1
                go = (self.check[nxt] == state) & (lens[active] > j)
                active, state, j = active[go], nxt[go], j + 1
                piece = self.value[state]
                hit = piece >= 0
                if hit.any():
                    w, p = active[hit], piece[hit]
                    reach(j, w, i, p, best[i, w] + self.score[p])
                    alone[w[chars[w] == j - i]] = False
            who = who[alone[who]]
            if len(who):
                reach(i + chars[who], who, i, -1, best[i, who] + self.unk_score)
        pos, every, steps = lens.copy(), np.arange(n), []
        while pos.any():
            steps.append((np.where(pos > 0, piece_at[pos, every], -2), pos))
            pos = np.where(pos > 0, start_of[pos, every], 0)
        if not steps:
            return [b""] * n
        paths = np.stack([p for p, _ in steps[::-1]], axis=1).astype("<i4")
        ends = np.stack([e for _, e in steps[::-1]], axis=1)
        used = paths != -2
        cuts = np.concatenate([[0], 4 * np.cumsum(used.sum(axis=1))]).tolist()
        packed = paths[used].tobytes()
        out = [packed[x:y] for x, y in zip(cuts, cuts[1:])]
        for k in np.flatnonzero((paths == -1).any(axis=1)):                  # characters without a piece
            ids, last = [], 0
            for p, e in zip(paths[k].tolist(), ends[k].tolist()):
                if p >= 0:
                    ids.append(p)
                elif p == -1:
                    ids += [self.byte_ids[x] for x in raw[k][last:e]] if self.byte_ids else [self.unk]
                last = e if p != -2 else last
            out[k] = np.array(ids, "<i4").tobytes()
        return out


def load_model(model: str) -> tuple[Unigram, list[str], dict[int, int]]:
    """(segmenter, piece by id, byte by id) of a SentencePiece model file."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model)
    ids = list(range(sp.vocab_size()))
    pieces = sp.id_to_piece(ids)
    byte_of = {i: int(pieces[i][3:5], 16) for i in ids if sp.is_byte(i)}
    plain = [i for i in ids if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
    check_vocabulary(pieces[i] for i in plain)
    byte_ids = [i for i, _ in sorted(byte_of.items(), key=lambda x: x[1])]
    uni = Unigram([pieces[i] for i in plain], [float(sp.get_score(i)) for i in plain], plain, sp.unk_id(),
                  byte_ids if len(byte_ids) == 256 else None)
    return uni, pieces, byte_of


def piece_bytes(pieces: list[str], byte_of: dict[int, int]) -> list[bytes]:
    """What each id stands for: a byte, or the piece with spaces for its marks."""
    return [bytes([byte_of[i]]) if i in byte_of else p.replace(MARK, " ").encode() for i, p in enumerate(pieces)]


def decode_ids(ids, table: list[bytes]) -> str:
    """The text of a list of ids."""
    text = b"".join(map(table.__getitem__, ids)).decode("utf-8", "replace")
    return text[1:] if text.startswith(" ") else text


def encode_documents(docs: DataFrame, model: str, cache_size: int = 1 << 16, decode: bool = False) -> DataFrame:
    """doc_id, text, ids (array<int>) for every document.  With ``decode``, the ids are also decoded
    (column decoded) in the same pass, so a task needs one worker and ids and text cross over once."""
    uni, *rest = load_model(model)
    shared = docs.sparkSession.sparkContext.broadcast((uni, piece_bytes(*rest) if decode else None))

    def encode(batches):
        uni, table = shared.value
        cache = _WORKER.setdefault(model, {})
        for pdf in slices(batches, chars=1 << 19):
            if len(cache) > cache_size:
                cache.clear()
            words = [pre_tokens(t) if isinstance(t, str) else [] for t in pdf["text"]]
            missing = [w for w in set(chain.from_iterable(words)) if w not in cache]
            known = cache if len(missing) <= cache_size else dict(cache)     # one huge run of rare words
            known.update(zip(missing, uni.segment([MARK + w.replace(" ", MARK) for w in missing])))
            ids = [np.frombuffer(b"".join(map(known.__getitem__, ws)), "<i4") for ws in words]
            out = {"doc_id": pdf["doc_id"], "text": pdf["text"], "ids": ids}
            if decode:
                out["decoded"] = [decode_ids(x.tolist(), table) for x in ids]
            yield pd.DataFrame(out)

    kind = dict(docs.select("doc_id").dtypes)["doc_id"]
    extra = ["decoded"] if decode else []
    return docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text") \
        .mapInPandas(encode, ", ".join(["doc_id string, text string, ids array<int>"] + [f"{c} string" for c in extra])) \
        .select(F.col("doc_id").cast(kind).alias("doc_id"), "text", "ids", *extra)


def decode_documents(encoded: DataFrame, model: str) -> DataFrame:
    """``encoded`` (with a column ids) plus ``decoded``."""
    shared = encoded.sparkSession.sparkContext.broadcast(piece_bytes(*load_model(model)[1:]))

    @F.pandas_udf("string")
    def decode(ids: pd.Series) -> pd.Series:
        known = shared.value
        return pd.Series([decode_ids(x.tolist(), known) if x is not None else "" for x in ids], dtype=object)

    return encoded.withColumn("decoded", decode("ids"))


def round_trip(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, n_tokens, n_byte_tokens, ids_sha256 (of the comma-joined ids), round_trip."""
    byte_ids = sorted(load_model(model)[2])
    low, high = (byte_ids[0], byte_ids[-1]) if byte_ids else (1, 0)
    done = encode_documents(docs, model, decode=True)
    return done.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.size(F.filter("ids", lambda i: i.between(low, high))).cast("long").alias("n_byte_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        (F.col("decoded") == F.replace(F.coalesce("text", F.lit("")), F.lit(MARK), F.lit(" "))).alias("round_trip"))
