"""Token counts without ids: each distinct pre-token is counted once.

A task cuts its texts into pre-tokens and gives, per group of pre-tokens, the distinct ones with the documents
they are in and how often (one pre-token of a task is one entry, however common it is).  A group meets in one
task, which counts each of its pre-tokens once and sums per document; the sums of the groups are then added for each
batch of documents that one task cut.  Batches are dealt to parts of about ``PART_BYTES`` of text, and a group holds
pre-tokens of one part: one that is in every document makes a group as large as that, not as the corpus.

Defined cases: a null or empty text has no bytes and no tokens; repeated rows and ids give a row each; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableferry.llm.pretokens import pieces
from tableferry.llm.vocabulary import Encoder, encoder
from tableferry.llm.words import joined, mix, raw_of, slices

#: Bytes of text whose pre-tokens meet in one group, about, of those that are cut before they are given on, and of a part.
GROUP_BYTES, TASK_BYTES, PART_BYTES = 8 << 20, 12 << 20, 1 << 28

_FREQUENCIES = "groups long, batch long, heads array<long>, ids array<long>, bytes array<long>, words array<string>, n array<int>, steps array<int>, times array<int>"

_SUMS = "batch long, rows array<long>, sums array<long>, heads array<long>, ids array<long>, bytes array<long>"


def _frequencies(groups: int, parts: int, tokenizer: str):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(tokenizer)
        specials = tuple(tool.specials)
        task = TaskContext.get().partitionId()
        for number, batch in enumerate(slices(batches, limit=TASK_BYTES)):
            hashes, docs, times, strings, at = [], [], [], {}, 0
            for part in slices(iter([batch])):
                found = pieces(part.column("text"), specials, tool.classes)
                text = np.repeat(np.arange(part.num_rows), np.diff(found.first)) + at
                order = np.lexsort((text, found.hash))
                h, d = found.hash[order], text[order]
                new = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (d[1:] != d[:-1])])) if len(h) else np.zeros(0, np.int64)
                hashes.append(h[new])
                docs.append(d[new])
                times.append(np.diff(np.append(new, len(h))))
                _, one = np.unique(h, return_index=True)
                for k, i in zip(h[one].tolist(), order[one].tolist(), strict=True):
                    if k not in strings:
                        strings[k] = found.of(i)
                at += part.num_rows
            h, d, t = joined(hashes), joined(docs, np.int64), joined(times, np.int64)
            group = (h % np.uint64(groups)).astype(np.int64)
            order = np.lexsort((d, h, group))
            h, d, t, group = h[order], d[order], t[order], group[order]
            new = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, np.int64)
            n = np.diff(np.append(new, len(h)))
            # Documents of a pre-token as steps from the one before.
            steps = np.diff(d, prepend=0)
            steps[new] = d[new]
            _, offsets = raw_of(batch.column("text"))
            sizes, ids = np.diff(offsets), batch.column("doc_id")
            row = np.arange(batch.num_rows)
            shown = np.union1d(group, row % groups)
            words = [strings[k] for k in h[new].tolist()]
            out, name = [], task << 32 | number
            part = int(mix(np.array([name], np.uint64))[0] % np.uint64(parts))
            for g in shown.tolist():
                a, b = np.searchsorted(group[new], [g, g + 1])
                x, y = np.searchsorted(group, [g, g + 1])
                heads = row[g::groups]
                out.append((part * groups + g, name, heads, ids.take(pa.array(heads)).to_pylist(), sizes[heads], words[a:b], n[a:b], steps[x:y], t[x:y]))
            kinds = [pa.int64(), pa.int64(), *[pa.list_(pa.int64())] * 3, pa.list_(pa.string()), *[pa.list_(pa.int32())] * 3]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], kind) for i, kind in enumerate(kinds)], [x.split()[0] for x in _FREQUENCIES.split(", ")])

    return cut


def _sizes(tool: Encoder, words: list[str]) -> np.ndarray:
    return np.array([len(x) for x in tool.encode(words)], np.int64)


def _summed(tokenizer: str):
    def add(table: pa.Table) -> pa.Table:
        tool = encoder(tokenizer)
        words = pc.list_flatten(table["words"]).combine_chunks()
        distinct = words.dictionary_encode() if len(words) else None
        size = _sizes(tool, distinct.dictionary.to_pylist())[distinct.indices.to_numpy()] if distinct is not None else np.zeros(0, np.int64)
        batches, at = table["batch"].to_pylist(), 0
        out = []
        for i, batch in enumerate(batches):
            row = {k: table[k][i].values for k in ("n", "steps", "times")}
            n, steps, times = (row[k].to_numpy() for k in ("n", "steps", "times"))
            per = np.repeat(size[at:at + len(n)], n) * times
            at += len(n)
            first = np.cumsum(n) - n
            total = np.cumsum(steps, dtype=np.int64)
            docs = total - np.repeat(total[first] - steps[first], n) if len(n) else total
            sums = np.bincount(docs, per).astype(np.int64)
            used = np.flatnonzero(sums)
            out.append((batch, used, sums[used]))
        kinds = [pa.int64(), *[pa.list_(pa.int64())] * 2]
        sums_of = [pa.array([x[i] for x in out], kind) for i, kind in enumerate(kinds)]
        return pa.Table.from_arrays([*sums_of, *(table[k].combine_chunks() for k in ("heads", "ids", "bytes"))], [x.split()[0] for x in _SUMS.split(", ")])

    return add


def _total(table: pa.Table) -> pa.Table:
    """The documents of one task's batch, with the sums of all groups."""
    rows, sums, heads, ids, sizes = (pc.list_flatten(table[k]).combine_chunks() for k in ("rows", "sums", "heads", "ids", "bytes"))
    total = np.bincount(rows.to_numpy(), sums.to_numpy(), len(heads)).astype(np.int64)
    return pa.Table.from_arrays([ids, sizes, pa.array(total[heads.to_numpy()])], ["doc_id", "n_bytes", "n_tokens"])


def token_counts(docs: DataFrame, tokenizer: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_tokens`` for each row of ``docs``."""
    source = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    total = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-total // PART_BYTES))
    busy = min(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1 << 10)
    groups = max(1, -(-max(busy, total // GROUP_BYTES) // parts))
    found = source.mapInArrow(_frequencies(groups, parts, tokenizer), _FREQUENCIES)
    sums = found.groupBy("groups").applyInArrow(_summed(tokenizer), _SUMS)
    # What meets here is bounded by the pairs of document and pre-token in TASK_BYTES of text.
    return sums.groupBy("batch").applyInArrow(_total, "doc_id long, n_bytes long, n_tokens long")
