import random
import zlib

import numpy as np
import pytest

public = pytest.importorskip("public_tokenizers")

from tableferry.llm import huffman, sentences, token_counts  # noqa: E402
from tableferry.llm.queries import BYTE_BPE, PIECE_BPE, QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public.path(BYTE_BPE))


def ids_of(library, texts):
    return [np.array(x.ids, "<u4") for x in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def stream(rows, library):
    """doc_id, start, n_tokens, crc of rows in order of ids; for rows of different ids."""
    rows, out, at = sorted(rows), [], 0
    for (i, _), ids in zip(rows, ids_of(library, [t for _, t in rows])):
        full = np.append(ids, 0).astype("<u4")
        out.append((i, at, len(full), zlib.crc32(full.tobytes())))
        at += len(full)
    return out


def test_files_of_the_whole_table(spark, library):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = QUERIES["op5_token_ids"](spark, SF).select("doc_id", "start", "n_tokens", "ids_crc32").collect()
    assert sorted(map(tuple, got)) == stream(map(tuple, docs), library)


def test_files_of_odd_texts(spark, library, odd, none):
    got = huffman.read_ids(spark, huffman.store(odd, public.path(BYTE_BPE)), with_ids=True).orderBy("start").collect()
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    ends = np.cumsum([0] + [r.n_tokens for r in got])
    assert [r.start for r in got] == ends[:-1].tolist()
    assert [r.doc_id is not None for r in got] == sorted(r.doc_id is not None for r in got)
    assert [r.doc_id for r in got if r.doc_id is not None] == sorted(i for i, _ in rows if i is not None)
    want = sorted((str(i), np.append(x, 0).astype("<u4").tobytes()) for (i, _), x in zip(rows, ids_of(library, [t for _, t in rows])))
    assert sorted((str(r.doc_id), bytes(r.ids)) for r in got) == want
    assert huffman.read_ids(spark, huffman.store(none, public.path(BYTE_BPE))).collect() == []


@pytest.mark.parametrize("n,kinds", [(1, 1), (5, 1), (1000, 2), (5000, 300), (300_000, 40_000)])
def test_codes_round_trip(n, kinds):
    rng = np.random.default_rng(n)
    ids = np.minimum((kinds * rng.random(n) ** 4).astype(np.int64), kinds - 1) * 3
    used, counts = np.unique(ids, return_counts=True)
    lengths = huffman.code_lengths(counts)
    assert (lengths <= huffman.LONGEST).all() and (0.5**lengths).sum() <= 1
    code, size = huffman.canonical(used, lengths)
    payload, marks = huffman.pack(ids, code, size)
    assert len(marks) == -(-n // huffman.STRIDE)
    assert (huffman.unpack(payload, marks, n, huffman.prefixes(code, size)) == ids).all()
    # Each checkpoint is enough to go on from.
    if len(marks) > 3:
        assert (huffman.unpack(payload, marks[2:], n - 2 * huffman.STRIDE, huffman.prefixes(code, size)) == ids[2 * huffman.STRIDE:]).all()


def test_lengths_are_optimal_and_limited():
    import heapq

    rng = random.Random(2)
    for _ in range(20):
        counts = [rng.randint(1, 50) for _ in range(rng.randint(2, 30))]
        heap, cost = counts[:], 0
        heapq.heapify(heap)
        while len(heap) > 1:
            a = heapq.heappop(heap) + heapq.heappop(heap)
            cost += a
            heapq.heappush(heap, a)
        assert int((huffman.code_lengths(np.array(counts)) * counts).sum()) == cost
    steep = np.array([2**i for i in range(25)])
    lengths = huffman.code_lengths(steep, 6)
    assert lengths.max() == 6 and (0.5**lengths).sum() == 1
    with pytest.raises(ValueError):
        huffman.code_lengths(np.ones(9), 3)


def test_counts_of_the_whole_table(spark, library):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = sorted((r.doc_id, len(r.text.encode()), len(x), len(x) > 512) for r, x in zip(docs, ids_of(library, [r.text for r in docs])))
    got = QUERIES["op7_token_counts"](spark, SF).select("doc_id", "n_bytes", "n_tokens", "over_limit").collect()
    assert sorted(map(tuple, got)) == want


def test_counts_of_odd_texts(spark, library, odd, none, monkeypatch):
    monkeypatch.setattr(token_counts, "GROUP_BYTES", 10_000)
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    want = sorted((str(i), len((t or "").encode()), len(x)) for (i, t), x in zip(rows, ids_of(library, [t for _, t in rows])))
    got = token_counts.token_counts(odd, public.path(BYTE_BPE)).collect()
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in got) == want
    assert token_counts.token_counts(none, public.path(BYTE_BPE)).collect() == []


@pytest.fixture(scope="module")
def model():
    return sentences.Pieces(public.path(PIECE_BPE))


def test_search_gives_the_librarys_ids(model):
    rng = random.Random(5)
    parts = ["a", "th", "e ", "  ", "\n", "中", "日本", "é", "ing", "x", "0", "12", "▁", "<s>", "ﬁ", "😀", "aaaa", " the", "\x00"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 60))) for _ in range(1500)]
    got = sentences.encode_slice(model, [*texts, None, ""])
    assert [x.tolist() for x in got] == [*model.library.encode(texts), [], []]
    for t, ids in zip(texts, got):
        assert model.decode(ids.tolist()) == t.replace("▁", " ")


def test_search_keeps_a_bounded_window(model):
    text = "".join(random.Random(1).choices("abcdefghij", k=20_000))
    model.held = 0
    runs = list(model.search(text))
    assert len(runs) > 100 and model.held < 6 * (model.longest + sentences.LOOK)
    dummy = model.library.encode(text)
    assert model.encode_normal(model.library.normalize(text)) == dummy


def test_search_by_scores(model):
    """The best sum of scores, against a full table over all splits."""
    other = sentences.Pieces(public.path(PIECE_BPE))
    other.merges = False
    rng = random.Random(8)
    for _ in range(200):
        text = "▁" + "".join(rng.choices("abcdeths▁", k=rng.randint(1, 120)))
        best = [0.0] + [-np.inf] * len(text)
        for i in range(len(text)):
            for j in range(i + 1, min(len(text), i + other.longest) + 1):
                score = other.score[other.ids[text[i:j]]] if text[i:j] in other.ids else other.unknown_score if j == i + 1 else -np.inf
                best[j] = max(best[j], best[i] + score)
        got = [i for run in other.search(text) for i in run]
        assert "".join(other.surface[i] for i in got) == text
        assert abs(sum(other.score[i] for i in got) - best[-1]) < 1e-3 * max(1, abs(best[-1]))


def test_pieces_in_tables(spark, model, odd, none):
    encoded = sentences.encode(odd, public.path(PIECE_BPE))
    texts = [r.text for r in odd.collect()]
    assert sorted(r.ids for r in encoded.collect()) == sorted(model.library.encode([t or "" for t in texts]))
    back = encoded.select(sentences.decoded(encoded["ids"], public.path(PIECE_BPE)).alias("text"))
    assert sorted(r.text for r in back.collect()) == sorted((t or "").replace("▁", " ") for t in texts)
    assert all(r.round_trip for r in sentences.summary(odd, public.path(PIECE_BPE)).collect())
    assert sentences.encode(none, public.path(PIECE_BPE)).collect() == []
    nothing = spark.createDataFrame([(None,)], "ids array<int>")
    assert nothing.select(sentences.decoded(nothing["ids"], public.path(PIECE_BPE)).alias("text")).first().text is None


def test_pieces_of_the_whole_table(spark, model):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in QUERIES["op6_sentence_pieces"](spark, SF).collect():
        ids = np.array(model.library.encode(docs[r.doc_id]), "<u4")
        assert (r.n_tokens, r.ids_crc32, r.round_trip) == (len(ids), zlib.crc32(ids.tobytes()), True)


def test_every_code_point_between_common_words(library):
    """As cut and encoded in large groups; a piece that the library cuts otherwise would shift the ids of others."""
    import pyarrow as pa

    from tableferry.llm.pretokens import pieces
    from tableferry.llm.vocabulary import encoder

    tool = encoder(public.path(BYTE_BPE))
    points = [chr(c) for c in [*range(0xD800), *range(0xE000, 0x110000)]]
    for at in range(0, len(points), 50_000):
        texts = ["the house" + "".join(f" saw{c}home {c}" for c in points[i:i + 25]) for i in range(at, min(at + 50_000, len(points)), 25)]
        found = pieces(pa.array(texts), tuple(tool.specials), tool.classes)
        _, first, inverse = np.unique(found.hash, return_index=True, return_inverse=True)
        ids = tool.encode([found.of(i) for i in first.tolist()])
        for k, wanted in enumerate(ids_of(library, texts)):
            assert np.array_equal(np.concatenate([ids[x] for x in inverse[found.first[k]:found.first[k + 1]]]), wanted), texts[k]


def test_a_piece_that_the_library_cuts_otherwise_does_not_shift_its_group(library):
    from tableferry.llm.vocabulary import Encoder

    group = [" the", " small", " house\U0002cead", " went", " ho-me", " and", " slept"]
    assert [x.tolist() for x in Encoder(public.path(BYTE_BPE)).encode(group)] == [x.tolist() for x in ids_of(library, group)]


def rare_rows():
    """A code point that is a letter in newer tables of Unicode only, and many ordinary documents after it."""
    return [(0, "before \U0002cead\U0002cead after, saw\U0002ceadhome"), *((i, "the small house went home and slept") for i in range(1, 59))]


def test_a_rare_character_does_not_change_other_documents(spark, library, tables):
    folder = tables(documents=spark.createDataFrame(rare_rows(), "doc_id long, text string").coalesce(1))
    got = QUERIES["op5_token_ids"](spark, folder).select("doc_id", "start", "n_tokens", "ids_crc32").collect()
    assert sorted(map(tuple, got)) == stream(rare_rows(), library)
    counts = {r.doc_id: r.n_tokens for r in QUERIES["op7_token_counts"](spark, folder).collect()}
    assert counts == {i: len(x) for (i, _), x in zip(rare_rows(), ids_of(library, [t for _, t in rare_rows()]))}


def test_counts_over_several_parts(spark, library, monkeypatch):
    """Batches of one group are dealt to parts; the sums are the same."""
    monkeypatch.setattr(token_counts, "PART_BYTES", 40_000)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").repartition(7)
    got = {r.doc_id: r.n_tokens for r in token_counts.token_counts(docs, public.path(BYTE_BPE)).collect()}
    rows = docs.collect()
    assert got == {r.doc_id: len(x) for r, x in zip(rows, ids_of(library, [r.text for r in rows]))}


SMALL = "/root/testdata/sf0.01"


def test_whole_larger_table(spark, library):
    docs = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES["op5_token_ids"](spark, SMALL).select("doc_id", "start", "n_tokens", "ids_crc32").collect()
    assert sorted(map(tuple, got)) == stream(docs, library)
    counts = {r.doc_id: r.n_tokens for r in QUERIES["op7_token_counts"](spark, SMALL).collect()}
    assert counts == {i: len(x) for (i, _), x in zip(docs, ids_of(library, [t for _, t in docs]))}


def test_known_strings_stay_within_their_number():
    """A worker that has seen many strings keeps those found again; ids are right all along."""
    from tableferry.llm.vocabulary import Known, laid_out

    tries, known = [], Known(np.int32, 1000)

    def ask(numbers):
        hashes = np.array(numbers, np.uint64) * np.uint64(0x9E3779B97F4A7C15)

        def encode(strings):
            tries.extend(strings)
            return [np.array([int(x)] * (int(x) % 4), np.int32) for x in strings]

        flat, total = laid_out(*known.look_up(hashes, np.ones(len(numbers), np.int64), lambda k: str(numbers[k]), encode), np.arange(len(numbers)))
        assert [flat[a:b].tolist() for a, b in zip(total, total[1:])] == [[n] * (n % 4) for n in numbers]
        assert sum(len(p.hash) for p in known.parts) <= 1000

    for i in range(200):
        ask([*range(50), *range(1000 + 90 * i, 1090 + 90 * i)])
    # Frequent strings were encoded once, rare ones went.
    assert all(tries.count(str(n)) == 1 for n in range(50)) and len(tries) == 50 + 200 * 90
    ask(list(range(5000, 5990)))
    ask([])


def test_what_a_look_up_copies():
    """Ids of the strings asked for are copied, not those of all that are known."""
    from tableferry.llm.vocabulary import Known

    known, encode = Known(np.int32), lambda strings: [np.zeros(5, np.int32)] * len(strings)
    known.look_up(np.arange(20_000, dtype=np.uint64), np.ones(20_000, np.int64), str, encode)
    flat, begin, size = known.look_up(np.array([3, 9], np.uint64), np.ones(2, np.int64), str, encode)
    assert len(flat) == 10 and begin.tolist() == [0, 5] and size.tolist() == [5, 5]


def test_slices_hold_few_bytes():
    import pyarrow as pa

    from tableferry.llm.words import slices

    batch = pa.RecordBatch.from_arrays([pa.array(["x" * 9, None, "é" * 5, "", "y" * 30, "z"])], ["text"]).slice(1)
    assert [s.column("text").to_pylist() for s in slices(iter([batch]), limit=10)] == [[None, "é" * 5, ""], ["y" * 30], ["z"]]
