"""Language-model scores by a weighted backoff automaton.

States are word histories that training has seen, shortest first the empty one.
An arc reads a word that training has seen after the history; where none fits, the
failure arc leads to the history without its first word. Weights are interpolated (a
Dirichlet prior on the shorter history's distribution):

    p(w | h) = (c(h w) + mu * p(w | shorter h)) / (c(h) + mu),

so an arc weighs its own share plus the rest, and the failure arc of a state weighs
mu / (c(h) + mu). Every distribution sums to one. The empty state is the add-one
unigram model and has an arc for every word.

The whole automaton never is in one place. Blocks of documents send their distinct
n-grams and counts to owners of hash ranges, owners answer with corpus counts, and
each block builds the states and arcs that its own texts can reach (`Automaton`), then
reads all its texts from left to right, a state in hand for each. Long texts are read
as several lanes: a state holds at most `order - 1` words, so a lane that first reads
that many words before its own start, from the empty state, is in the very state that
reading from the text's start leads to.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfsight.llm import golomb
from shelfsight.llm.arrays import LOWER, buffers, firsts, mix, slices, span_hashes, word_spans
from shelfsight.llm.common import shuffle_partitions
from shelfsight.sources.scratch import materialize

#: Prior weight of each order above the first; one entry is a bigram model.
PRIOR = (300.0,)
#: Text in one block, and n-grams that one owner should hold.
BLOCK_BYTES, BLOCK_ROWS, OWNER_KEYS = 6 << 20, 1 << 16, 1 << 21
#: Tokens that a lane reads of a text beyond its first words.
LANE = 256
START, END = np.uint64(0x5354415254), np.uint64(0x454E44)
_STEP = np.uint64(0xD6E8FEB86659FD93)
BLOCK = "block long, ids array<long>, held array<boolean>, lengths array<int>, n long, rice int, words binary, ranks binary, codes binary"


def token_stream(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens, an end after each text, and the number of tokens of each text."""
    data = LOWER[data]
    starts, ends, rows = word_spans(data, offsets)
    n = len(offsets) - 1
    lengths = np.diff(firsts(rows, n)) + 1
    last = np.cumsum(lengths) - 1
    out = np.full(int(lengths.sum()), END, dtype=np.uint64)
    is_word = np.ones(len(out), dtype=bool)
    is_word[last] = False
    out[is_word] = span_hashes(data, starts, ends)
    return out, lengths


def grams(tokens: np.ndarray, lengths: np.ndarray, order: int) -> list[np.ndarray]:
    """For orders 1 to `order`, the key of the n-gram that ends at each token; before a text
    stand start marks. The lowest bit is 0 for words."""
    place = np.arange(len(tokens)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    history, one = np.zeros(len(tokens), dtype=np.uint64), np.uint64(1)
    keys = [tokens & ~one]
    for k in range(1, order):
        back = np.full(len(tokens), START, dtype=np.uint64)
        back[k:] = tokens[:-k] if k < len(tokens) else back[k:]
        back[place < k] = START
        history = mix(history * _STEP + back + np.uint64(k))
        keys.append(mix(history + mix(tokens)) | one)
    return keys


def _block_keys(tokens, lengths, held, order):
    """Distinct n-gram keys of a block and their training counts; where each token's are."""
    trains = np.repeat(~held, lengths)
    found = grams(tokens, lengths, order)
    flat = np.concatenate(found)
    keys, inverse = np.unique(flat, return_inverse=True)
    counts = np.bincount(inverse, weights=np.tile(trains, len(found)), minlength=len(keys)).astype(np.int64)
    return keys, counts, inverse.reshape(len(found), -1)


class Automaton:
    """The part of the model that one block's texts can reach.

    State 0 is the empty history, state 1 + k the history that is the block's k-th n-gram,
    and the last `order - 1` states are histories of start marks alone. Arcs are sorted by
    (state, word); `fail_to` and `fail_weight` are the failure arc of each state.
    """

    def __init__(self, codes, lengths, places, counts, all_tokens: int, vocabulary: int, prior: Sequence[float]):
        self.order = order = len(prior) + 1
        self.words = int(codes.max()) + 1
        n, states = len(counts), len(counts) + order
        heads = np.cumsum(lengths) - lengths
        ends = heads + lengths - 1
        # Each training text ends once, so the count of the end is that of the start marks.
        texts = int(counts[places[0][ends[0]]])
        self.start = n + order - 1 if texts else 0
        self.fail_to = np.zeros(states, dtype=np.int64)
        self.fail_weight = np.zeros(states)

        _, first = np.unique(codes, return_index=True)
        p = (counts[places[0]] + 1.0) / (all_tokens + vocabulary + 1.0)
        to = np.where(counts[places[0]] > 0, 1 + places[0], 0) if order > 1 else np.zeros_like(places[0])
        arcs = [(codes[first], np.log10(p[first]), to[first])]
        for k in range(1, order):
            # The history of k words before a token is the n-gram that ends at the token before it.
            source = np.empty(len(codes), dtype=np.int64)
            source[1:] = 1 + places[k - 1][:-1]
            source[heads] = n + k
            seen = np.append(counts, [texts] * (order - 1))[source - 1]
            p = (counts[places[k]] + prior[k - 1] * p) / (seen + prior[k - 1])
            kept, first = np.unique(places[k], return_index=True)
            first = first[counts[kept] > 0]
            reached = 1 + places[min(k + 1, order - 1) - 1][first]
            arcs.append((source[first] * self.words + codes[first], np.log10(p[first]), reached))
            own, at = np.unique(source, return_index=True)
            self.fail_weight[own] = np.log10(prior[k - 1] / (seen[at] + prior[k - 1]))
            self.fail_to[own] = shorter[at] if k > 1 else 0
            shorter = source
        found = [np.concatenate(part) for part in zip(*arcs)]
        by_arc = np.argsort(found[0], kind="stable")
        self.arc, self.weight, self.to = (part[by_arc] for part in found)

    def step(self, state: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Read one word in each state: the log10 weight and the state reached."""
        weight, reached = np.zeros(len(state)), np.zeros(len(state), dtype=np.int64)
        rest = np.arange(len(state))
        while len(rest):
            wanted = state * self.words + word
            at = np.minimum(np.searchsorted(self.arc, wanted), len(self.arc) - 1)
            hit = self.arc[at] == wanted
            weight[rest[hit]] += self.weight[at[hit]]
            reached[rest[hit]] = self.to[at[hit]]
            rest, state, word = rest[~hit], state[~hit], word[~hit]
            weight[rest] += self.fail_weight[state]
            state = self.fail_to[state]
        return weight, reached

    def read(self, codes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The log10 probability of each text, read from left to right."""
        heads = np.cumsum(lengths) - lengths
        many = -(-lengths // LANE)
        text = np.repeat(np.arange(len(lengths)), many)
        skipped = (np.arange(len(text)) - np.repeat(np.cumsum(many) - many, many)) * LANE
        warm = np.minimum(skipped, self.order - 1)
        steps = np.minimum(lengths[text] - skipped, LANE) + warm
        by_steps = np.argsort(-steps, kind="stable")
        text, warm, steps = text[by_steps], warm[by_steps], steps[by_steps]
        at = heads[text] + skipped[by_steps] - warm
        state = np.where(skipped[by_steps] == 0, self.start, 0)
        total = np.zeros(len(text))
        live = np.searchsorted(-steps, -np.arange(int(steps[0])), side="left")
        for t, n in enumerate(live.tolist()):
            weight, state[:n] = self.step(state[:n], codes[at[:n] + t])
            total[:n] += np.where(t >= warm[:n], weight, 0.0)
        return np.bincount(text, weights=total, minlength=len(lengths))


def _make_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, number, size = TaskContext.get().partitionId(), 0, 0
    ids, held, streams, lengths = [], [], [], []

    def flush() -> pa.RecordBatch:
        tokens = np.concatenate(streams)
        words, inverse, times = np.unique(tokens, return_inverse=True, return_counts=True)
        by_rank = np.argsort(-times, kind="stable")
        rank = np.empty(len(words), dtype=np.int64)
        rank[by_rank] = np.arange(len(words))
        rice, blob = golomb.encode(words)
        row = {
            "block": (part << 20) + number, "ids": ids, "held": held, "lengths": np.concatenate(lengths).tolist(),
            "n": len(words), "rice": rice, "words": blob,
            "ranks": golomb.pack_numbers(by_rank), "codes": golomb.pack_numbers(rank[inverse]),
        }
        kinds = {
            "block": pa.int64(), "ids": pa.list_(pa.int64()), "held": pa.list_(pa.bool_()), "lengths": pa.list_(pa.int32()),
            "n": pa.int64(), "rice": pa.int32(), "words": pa.binary(), "ranks": pa.binary(), "codes": pa.binary(),
        }
        return pa.RecordBatch.from_arrays([pa.array([row[c]], kinds[c]) for c in kinds], names=list(kinds))

    for batch in batches:
        for piece in slices(batch, "text"):
            data, offsets = buffers(piece.column("text"))
            stream, count = token_stream(data, offsets)
            streams.append(stream)
            lengths.append(count)
            ids += piece.column("doc_id").to_pylist()
            held += piece.column("held_out").to_pylist()
            size += len(data)
            if size >= BLOCK_BYTES or len(ids) >= BLOCK_ROWS:
                yield flush()
                number, size = number + 1, 0
                ids, held, streams, lengths = [], [], [], []
    if ids:
        yield flush()


def _unpack(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The code of each token within the block, its hash, the lengths and the held-out flags."""
    words = golomb.decode(row["n"], row["rice"], row["words"])
    codes = golomb.unpack_numbers(row["codes"])
    tokens = words[golomb.unpack_numbers(row["ranks"])][codes]
    return codes, tokens, np.array(row["lengths"], dtype=np.int64), np.array(row["held"], dtype=bool)


def _rows(source: pa.RecordBatch | pa.Table) -> Iterator[dict]:
    for k in range(source.num_rows):
        yield source.slice(k, 1).to_pylist()[0]


def _sum_counts(keys: np.ndarray, sender: np.ndarray, extra: np.ndarray | None) -> tuple[np.ndarray, int]:
    """Corpus counts of the keys; the tally is the number of words that training has seen."""
    distinct, inverse = np.unique(keys, return_inverse=True)
    total = np.bincount(inverse, weights=extra, minlength=len(distinct)).astype(np.int64)
    return total[inverse], int(((distinct & np.uint64(1) == 0) & (total > 0)).sum())


def lm_scores(
    docs: DataFrame, prior: Sequence[float] = PRIOR, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Score every text with a model learned from the rows that are not held out.

    Held out are ids whose crc32 (of their decimal text; a null id is empty) mod 7 is 2.
    A null text is empty: one end token. Repeated rows count as often as they come. An
    empty table gives no rows. `len(prior)` sets the longest history. Words are told
    apart by 64-bit hashes. Other columns are not read. Starts Spark jobs.
    """
    spark, order = docs.sparkSession, len(prior) + 1
    held = F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary")) % 7 == 2
    chosen = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"), held.alias("held_out"))
    blocks = materialize(chosen.mapInArrow(_make_blocks, BLOCK), "blocks")
    pairs = F.arrays_zip("lengths", "held")
    total = F.aggregate(pairs, F.lit(0).cast("long"), lambda a, p: a + F.when(p["held"], 0).otherwise(p["lengths"]))
    sizes = blocks.agg(F.sum(total), F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, n: a + n))).first()
    all_tokens = sizes[0] or 0
    partitions = shuffle_partitions(spark)
    owners = max(2 * partitions, -(-(sizes[1] or 0) // OWNER_KEYS))

    def ask(batches):
        for batch in batches:
            for row in _rows(batch):
                keys, counts, _ = _block_keys(*_unpack(row)[1:], order)
                yield golomb.request_batch(golomb.requests(row["block"], keys, owners, counts))

    replies = materialize(golomb.exchange(blocks.mapInArrow(ask, golomb.REQUEST), _sum_counts, partitions), "replies")
    vocabulary = golomb.tally_of(replies)

    def score(sent: pa.Table, answers: pa.Table) -> pa.Table:
        out = []
        for row in _rows(sent):
            codes, tokens, lengths, held_out = _unpack(row)
            keys, _, places = _block_keys(tokens, lengths, held_out, order)
            counts = golomb.replies_of(answers, keys, owners)
            model = Automaton(codes, lengths, places, counts, all_tokens, vocabulary, prior).read(codes, lengths)
            heads, own = np.cumsum(lengths) - lengths, counts[places[0]]
            base = np.add.reduceat(np.log10((own + 1.0) / (all_tokens + vocabulary + 1.0)), heads)
            known = np.add.reduceat((own > 0).astype(np.int64), heads)
            names = ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
            columns = [pa.array(row["ids"], pa.int64()), pa.array(held_out), pa.array(lengths), pa.array(known)]
            columns += [pa.array(np.full(len(lengths), all_tokens)), pa.array(base), pa.array(model)]
            out.append(pa.table(dict(zip(names, columns))))
        return pa.concat_tables(out)

    return (
        blocks.groupBy("block")
        .cogroup(replies.filter("block >= 0").groupBy("block"))
        .applyInArrow(
            score,
            "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double",
        )
    )
