"""Streaming BPE, hard negatives and alignment against the libraries and brute force."""

import hashlib
import math
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
from branchledger.llm import alignment, hard_negatives, stream_bpe
from branchledger.llm.hard_negatives import Mining
from pyspark.sql import functions as F

WORDS, BYTES, PIECES = P.path("word_bpe_49k.json"), P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def word_library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(WORDS)


def ids_of(data):
    return np.frombuffer(data, "<u4").tolist()


def test_stream_bpe_as_the_library(odd, odd_rows, empty, word_library):
    coded = stream_bpe.encode(odd, WORDS)
    assert coded.columns == [*odd.columns, "ids"]
    got = stream_bpe.decode(coded, WORDS, decimal_col="decimal").collect()
    want = Counter()
    for i, text in odd_rows:
        ids = word_library.encode(text or "", add_special_tokens=False).ids
        want[i, tuple(ids), word_library.decode(ids, skip_special_tokens=False), " ".join(map(str, ids))] += 1
    assert Counter((r.doc_id, tuple(ids_of(r.ids)), r.decoded, bytes(r.decimal).decode()) for r in got) == want
    assert stream_bpe.decode(stream_bpe.encode(empty, WORDS), WORDS).count() == 0


def test_stream_bpe_in_pieces_of_any_size(word_library):
    v, rng = stream_bpe.vocabulary(WORDS), random.Random(1)
    parts = [
        "a", "B", "the", "'s", "'", "'re", "'l", "l", " ", "  ", "\n", "\x1c", "\x85", "​", "\xa0", "é", "é", "́", "Σ", "İ", "ß", "漢字", "한",
        "한", "1", "٣", "#", "$$", "<|endoftext|>", "<|startoftext|>", "<|endof", "😂", "😂" * 9, "ǅ", "ﬁ", "...", "̈́", " ", "x" * 90,
    ]
    for _ in range(600):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(1, 40)))
        want = word_library.encode(text, add_special_tokens=False).ids
        for piece, run in ((1, 3), (3, 70), (1 << 15, 4096)):
            encoder = stream_bpe.Encoder(v, run=run)
            out = [ids for a in range(0, len(text), piece) for ids in encoder.feed(text[a : a + piece])]
            assert ids_of(b"".join([*out, *encoder.finish()])) == want, text
        decoder = stream_bpe.Decoder(v)
        assert "".join(decoder.feed([i]) for i in want) + decoder.finish() == word_library.decode(want, skip_special_tokens=False)


def test_stream_bpe_of_long_words_in_constant_memory(word_library):
    v, rng = stream_bpe.vocabulary(WORDS), random.Random(2)
    assert v.merges.lookahead < 2000
    most = 4096 + 2 * v.merges.lookahead
    for text in ("a" * 60_000, "ab" * 30_000, "😂" * 20_000, "#!" * 20_000, " " * 60_000, "'" * 30_000, "".join(rng.choice("abcdehilnorst") for _ in range(60_000))):
        encoder, out = stream_bpe.Encoder(v), []
        for a in range(0, len(text), 1000):
            out.extend(encoder.feed(text[a : a + 1000]))
            held = len(encoder.open[0].held) if encoder.open else 0
            assert held <= most + 4096 and len(encoder.text) + len(encoder.plain) + len(encoder.raw) <= 6000
        assert ids_of(b"".join([*out, *encoder.finish()])) == word_library.encode(text, add_special_tokens=False).ids


def test_lookahead_of_small_merge_lists():
    """Tokens that end a lookahead before the end of what was read never change, whatever follows."""
    rng = random.Random(4)
    glyphs = stream_bpe.byte_glyphs()
    for _ in range(60):
        vocab = {g + end: 2 * b + bool(end) for b, g in enumerate(glyphs) for end in ("", "!!")}
        known, merges = list("abc"), []
        while len(merges) < 12:
            pair = rng.choice(known), rng.choice(known)
            if "".join(pair) not in vocab:
                vocab["".join(pair)] = len(vocab)
                merges.append(pair)
                known.append("".join(pair))
        m = stream_bpe.Merges(vocab, merges, "!!")
        for _ in range(40):
            text = [m.inner[ord(rng.choice("abc"))] for _ in range(m.lookahead + 60)]
            cut = rng.randrange(m.lookahead, len(text))
            whole, part = m.apply(text), m.apply(text[:cut])
            assert whole == m._long(text)
            final = cut - m.lookahead

            def ending(tokens):
                end = np.cumsum([m.length[t] for t in tokens]).tolist()
                return [(t, e) for t, e in zip(tokens, end) if e <= final]

            early = ending(part)
            assert early == ending(whole)[: len(early)] and (not early or len(ending(whole)) == len(early))


def test_byte_decoder_waits_for_whole_characters():
    v = stream_bpe.vocabulary(WORDS)
    glyphs = stream_bpe.byte_glyphs()

    class Bytes:
        tokens = {i: g for i, g in enumerate(glyphs)}
        joined = False

    decoder = stream_bpe.Decoder(Bytes)
    assert [decoder.feed([b]) for b in "aé漢".encode()] == ["a", "", "é", "", "", "漢"]
    assert decoder.feed([0xE6]) + decoder.finish() == "�"
    assert v.joined


def mined(rows, positives, negatives, low, high):
    """The contract, one pair at a time in Python's integers."""
    rows = [(i, k, [*c]) for i, k, c in rows if i is not None and k is not None and c is not None and None not in c]

    def dot(x, y):
        return sum(a * b for a, b in zip(x, y))

    out = Counter()
    for i, k, c in rows:
        if i % 10:
            continue
        scored = sorted((-dot(c, x), j, label) for j, label, x in rows)
        for s, j, _ in [t for t in scored if t[2] == k and t[1] != i][:positives]:
            fits = [(n, m) for n, m, label in scored if label != k and low * -s <= 100 * -n <= high * -s][:negatives]
            for rank, (n, m) in enumerate(fits, 1):
                out[i, j, rank, m, -s, -n] += 1
    return out


@pytest.mark.parametrize("dims,size,p", [(3, 4, Mining(block_rows=7, split_rows=50, chunk=640)), (64, 60, Mining()), (40, 3_000_000, Mining(2, 30, (0, 100), block_bytes=2000))])
def test_hard_negatives(spark, dims, size, p):
    rng = random.Random(dims)
    rows = [(i, rng.randrange(3), [rng.randint(-size, size) for _ in range(dims)]) for i in range(300)]
    rows += [rows[4], rows[20], (None, 1, [1] * dims), (301, None, [1] * dims), (302, 1, None), (303, 1, [None] * dims), (310, 9, [0] * dims), (305, 1, [size] * (dims - 1)), (-10, 2, [size] * dims)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "id long, label int, components array<long>, slot string, score int")
    got = hard_negatives.mine(df, F.col("id") % 10 == 0, p)
    assert Counter(map(tuple, got.collect())) == mined(rows, p.positives, p.negatives, *p.window)
    assert hard_negatives.mine(df.limit(0), F.col("id") % 10 == 0).count() == 0


def test_scores_are_exact():
    rng = np.random.default_rng(5)
    for dims, size in ((1, 2**26), (64, 256), (300, 20_000), (2000, 100_000)):
        x, y = rng.integers(-size, size + 1, (2, 20, dims))
        primes = hard_negatives.primes_for(dims, size * size * dims)
        assert dims * max(p // 2 for p in primes) ** 2 <= 2**24 and math.prod(primes) > 2 * size * size * dims
        own = hard_negatives.products(hard_negatives.residues(x, primes), hard_negatives.residues(y, primes), primes)
        assert (own == x @ y.T).all()


def test_scores_beyond_the_exact_fail(spark):
    df = spark.createDataFrame([(0, 1, [2**40])], "id long, label int, components array<long>")
    with pytest.raises(ValueError, match="beyond"):
        hard_negatives.mine(df, F.col("id") == 0)


def test_integers_of_vectors(spark):
    df = spark.createDataFrame([([0.5, -0.001],), ([float("nan")],), ([None],), ([float("-inf")],), (None,), ([],)], "v array<float>")
    assert [r[0] for r in df.select(hard_negatives.integers("v")).collect()] == [[128, -1], None, None, None, None, []]


def alignments(rows):
    """Per row what the contract asks for, token by token, by the libraries on whole texts."""
    import sentencepiece
    from tokenizers import Tokenizer

    left = Tokenizer.from_file(BYTES)
    left.encode_special_tokens = True
    right = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    glyphs = {g: b for b, g in enumerate(stream_bpe.byte_glyphs())}
    found, docs_with = [], Counter()
    for i, text in rows:
        data = (" " + text).encode() if text else b""
        a = [(t, bytes(glyphs[g] for g in left.id_to_token(t))) for t in left.encode(data.decode(), add_special_tokens=False).ids] if text else []
        b = []
        for t in right.encode(text) if text else []:
            piece = right.id_to_piece(t)
            b.append((t, bytes([int(piece[3:5], 16)]) if right.is_byte(t) else piece.replace("▁", " ").encode()))
        if b"".join(x for _, x in a) != data or b"".join(x for _, x in b) != data:
            a, b = [], []
        spans = []
        for own in (a, b):
            at, out = 0, []
            for t, x in own:
                out.append((t, at, at + len(x)))
                at += len(x)
            spans.append(out)
        links, j = [], 0
        for t, s, e in spans[0]:
            while j and spans[1][j - 1][2] > s:
                j -= 1
            while spans[1][j][2] <= s:
                j += 1
            k = j
            while k < len(spans[1]) and spans[1][k][1] < e:
                links.append((t, spans[1][k][0]))
                k += 1
        common = sorted({e for _, _, e in spans[0]} & {e for _, _, e in spans[1]})
        groups, start = [], 0
        for end in common:
            groups.append("|".join(",".join(str(t) for t, _, e in own if start < e <= end) for own in spans))
            start = end
        docs_with.update(set(links))
        found.append((i, len(a), len(b), len(groups), len(links), hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "", links))
    highest = defaultdict(int)
    for (t, _), n in docs_with.items():
        highest[t] = max(highest[t], n)
    return Counter((*x[:6], sum(docs_with[k] == highest[k[0]] for k in x[6]), sum(docs_with[k] for k in x[6])) for x in found)


ALIGNED = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"]


@pytest.mark.parametrize("sizes", [(16 << 20, 1 << 20), (3000, 1000), (1, 1)])
def test_alignment(odd, odd_rows, sizes):
    short = [(i, t) for i, t in odd_rows if not t or len(t) < 50_000]  # the brute force is quadratic
    got = alignment.aligned(odd.where("text is null or length(text) < 50000"), BYTES, PIECES, *sizes)
    assert Counter(map(tuple, got.select(ALIGNED).collect())) == alignments(short)


def test_alignment_of_mixed_texts(spark, empty):
    rng = random.Random(6)
    parts = ["the", "Straße", " ", "  ", "    ", "\n", "\t", "<s>", "<0x0A>", "<|endoftext|>", "日本語", "😂", "\x00", "'s", "123", "re", "ing", "\xa0", "é", " "]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randint(1, 30)))) for i in range(300)]
    rows += [(900, "a▁b"), (901, " "), (902, "   "), (903, "▁"), (904, " x "), (905, "the the"), (905, "the the")]
    got = alignment.aligned(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), BYTES, PIECES, 500, 200)
    assert Counter(map(tuple, got.select(ALIGNED).collect())) == alignments(rows)
    assert alignment.aligned(empty, BYTES, PIECES).count() == 0
