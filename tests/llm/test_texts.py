"""Operators that judge or convert each text by itself, archives and packing."""

import dataclasses
import hashlib
import pathlib
import random
import re
import struct
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
import zstandard
from branchledger.llm import bpe, language_id, licenses, packing, quality_classifier, quality_rules, warc
from branchledger.llm.common import new_folder, remainder, shared_folder
from pyspark.sql import functions as F

RANKS = P.path("byte_bpe_50k.tiktoken")
TOKENS = P.path("byte_bpe_50k.json")


def test_bpe_round_trip(odd, odd_rows):
    enc = bpe.encoding(RANKS, P.PATTERN)
    got = bpe.decode(bpe.encode(odd, RANKS, P.PATTERN), RANKS, P.PATTERN).collect()
    want = Counter((i, np.array(enc.encode_ordinary(t or ""), "<u4").tobytes(), (t or "").encode()) for i, t in odd_rows)
    assert Counter((r.doc_id, bytes(r.ids), bytes(r.decoded)) for r in got) == want


def test_bpe_pieces_are_cut_safely():
    rng, enc = random.Random(1), bpe.encoding(RANKS, P.PATTERN)
    text = "".join(rng.choice(["ab", " ", "  ", "\n", "'s", "7", "é", " ", "!?", "\t "]) for _ in range(5000))
    for most in (1, 7, 100):
        assert "".join(bpe.pieces(text, most)) == text
        assert np.frombuffer(bpe.encode_text(text, enc, most), "<u4").tolist() == enc.encode_ordinary(text)
    assert bpe.decode_ids(np.array([255, 200], "<u4").tobytes(), enc) == enc.decode_bytes([255, 200])


@pytest.mark.parametrize("text", [" ", "\n", "a", "abc", "\n \t", "#!", "'", "é", "😂", "漢字", "1"])
def test_bpe_of_matches_in_parts(text):
    enc = bpe.encoding(RANKS, P.PATTERN)
    for text in (text * 4000, text * 4000 + "x", "x" + text * 4000 + " y"):
        assert np.frombuffer(bpe.encode_text(text, enc, 500), "<u4").tolist() == enc.encode_ordinary(text)


@pytest.mark.parametrize("letter", [" ", "\n", "a"])
def test_bpe_of_five_million_characters(letter):
    enc = bpe.encoding(RANKS, P.PATTERN)
    ids = bpe.encode_text(letter * 5_000_000, enc)
    assert bpe.decode_ids(ids, enc) == letter.encode() * 5_000_000
    # What an even run settles to, from runs that the library takes whole.
    more = len(enc.encode_ordinary(letter * 20_480)) - len(enc.encode_ordinary(letter * 10_240))
    assert abs(len(ids) / 4 - more * 5_000_000 / 10_240) < 100


def test_packing(odd, odd_rows):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(TOKENS)
    got = packing.packed(odd, TOKENS, open_bins=2).collect()
    want = Counter()
    for i, text in odd_rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        first, start, piece = len(ids) % 2048 or 2048, 0, 0
        for until in range(first, len(ids) + 1, 2048):
            want[i, piece, start, until - start, zlib.crc32(np.array(ids[start:until], "<u4").tobytes())] += 1
            start, piece = until, piece + 1
    assert Counter((r.id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    bins = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in bins.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 2048


def test_cuts_before_white_space_keep_the_ids():
    tokens, parts = packing.Tokens(TOKENS), ["a", "é's", ".", " ", "\n", "\t", "  ", "\n\n", "日本", "\0"]
    rng = random.Random(5)
    texts = ["", " ", "\n\n", "   x", "a\n "] + ["".join(rng.choices(parts, k=rng.randint(1, 9))) for _ in range(3000)]
    whole = tokens.tokenizer.encode_batch(texts, add_special_tokens=False)
    assert list(tokens.ids(texts)) == [np.array(e.ids, "<u4").tobytes() for e in whole]
    own, which, ends = packing._cut(["b a a", "", " a\nb"])
    assert [own[i] for i in which] == ["b", " a", " a", " a", "\nb"] and len(own) == 3 and ends.tolist() == [3, 3, 5]


def test_words_are_tokenised_as_in_their_text():
    rng = random.Random(2)
    parts = ["ab", "Xyz", " ", "  ", "\n", "\t", "'s", "'ll", "12", "é", ".", ",", "!!", "$$$", " ", " ", "\x1d", "日本"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(60))) for _ in range(500)]
    tokens = packing.Tokens(TOKENS, most=50)
    for a in range(0, 500, 50):
        assert list(tokens.ids(texts[a : a + 50])) == [tokens._encode([t])[0] for t in texts[a : a + 50]]


def test_bins_close_the_fullest_first():
    bins = packing.OpenBins(10, 2)
    assert [bins.place(n) for n in (6, 7, 8, 3, 4)] == [(0, 0), (1, 0), (2, 0), (1, 7), (0, 6)]
    assert bins.remaining() == []  # bin 2, the fullest of three, was closed


def test_rules(odd, odd_rows):
    got = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in quality_rules.quality_rules(odd).collect())
    want = Counter()
    for i, t in odd_rows:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        count = Counter(tuple(w[j : j + 8]) for j in range(len(w) - 7))
        inside = {k for j in range(len(w) - 7) if count[tuple(w[j : j + 8])] > 1 for k in range(j, j + 8)}
        seen, twice = set(), 0
        for line in t.split("\n"):
            if re.search(r"[^\x20\x09-\x0D]", line):
                twice += line in seen
                seen.add(line)
        want[i, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), twice, len(inside), len(w) < 20 or 100 * len(inside) > 30 * len(w)] += 1
    assert got == want


def test_rules_verdict_by_brute_force():
    rng, limits = random.Random(4), quality_rules.Limits()
    texts = [" ".join(rng.choice("abcdefgh") * rng.randrange(1, 4) for _ in range(rng.randrange(20, 90))) for _ in range(200)]
    measured = quality_rules.measure([t.encode() for t in texts], limits)
    for i, text in enumerate(texts):
        w = text.split()
        for n, _ in limits.covered:
            seen, inside = set(), set()
            for j in range(len(w) - n + 1):
                gram = tuple(w[j : j + n])
                if gram in seen:
                    inside.update(range(j, j + n))
                seen.add(gram)
            assert measured[f"covered_{n}"][i] == sum(len(w[k]) for k in inside)


def test_rules_kept_by_brute_force():
    """Line share, symbol share and n-gram coverage each decide for some texts."""
    rng, limits = random.Random(5), quality_rules.Limits()
    texts = []
    for i in range(400):
        lines = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(rng.randrange(1, 12))) for _ in range(rng.randrange(2, 9))]
        for _ in range(rng.randrange(4) if i % 2 else 0):
            lines.insert(rng.randrange(len(lines) + 1), rng.choice(lines))
        texts.append("\n".join(lines) + "".join(rng.choice(" #*$%&|<>x") for _ in range(rng.choice([0, 5, 40]))))
    measured = quality_rules.measure([t.encode() for t in texts], limits)
    failed, kept = quality_rules.verdicts(measured, limits)
    reasons = Counter()
    for i, text in enumerate(texts):
        w = text.split()
        chars, seen, doubled = sum(map(len, w)), set(), 0
        for line in text.split("\n"):
            if line in seen:
                doubled += len("".join(line.split()))
            elif line.strip():
                seen.add(line)
        count = Counter(tuple(w[j : j + 8]) for j in range(len(w) - 7))
        inside = {k for j in range(len(w) - 7) if count[tuple(w[j : j + 8])] > 1 for k in range(j, j + 8)}
        base = len(w) < limits.least_words or 100 * len(inside) > limits.repeat_words * len(w)
        lines, symbols = doubled > limits.line_chars * chars, sum(c in "#*$%&|<>" for c in text) > limits.symbols * len(w)
        grams = False
        for n, share in limits.covered:
            met, covered = set(), set()
            for j in range(len(w) - n + 1):
                if tuple(w[j : j + n]) in met:
                    covered.update(range(j, j + n))
                met.add(tuple(w[j : j + n]))
            grams |= sum(len(w[k]) for k in covered) > share * chars
        assert failed[i] == base and kept[i] == (not (base or lines or symbols or grams))
        reasons[base, lines, symbols, grams] += 1
    assert {(False, True, False, False), (False, False, True, False), (False, False, False, False)} <= set(reasons)


def test_archives(spark):
    big = "é<p>" * 60
    rows = [(5, "u", big), (3, None, big), (9, "a b\r\nx", big), (1, "v", None), (2, "w", ""), (4, "z", "tiny"), (6, "z", "tiny"), (None, "n", big), (3, "again", big)]
    got = warc.round_trip(spark.createDataFrame(rows, "page_id long, url string, html string")).select(
        warc.page_of("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", warc.page_of("refers_to").alias("of"), "target_uri"
    ).collect()
    want = Counter()
    for i, _, html in rows:
        data = (html or "").encode()
        again = len(data) >= 100 and i != 3
        want[i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", 3 if again else None] += 1
    assert Counter(tuple(r)[:5] for r in got) == want
    assert {r.target_uri for r in got if r.page_id == 9} == {"a%20b%0D%0Ax"}
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.round_trip(none).collect() == []


def test_archives_with_a_dictionary(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    archives = warc.write_archives(pages, new_folder(spark, "warc"), warc.Writing(sample_records=40, archive_bytes=10_000))
    assert archives.count() > 1
    first = []
    for r in archives.collect():
        with open(r.path.removeprefix("file:"), "rb") as file:
            first.append(struct.unpack("<I", file.read(4))[0])
    assert set(first) == {warc.DICTIONARY_FRAME}
    got = {r.page: bytes(r.payload).decode() for r in warc.read_archives(spark, archives).select(warc.page_of("record_id").alias("page"), "payload").collect()}
    assert got == {r.page_id: r.html or "" for r in pages.collect()}


def test_small_archives_have_a_dictionary(spark):
    for n in (1, 2, 7):
        pages = spark.createDataFrame([(i, None, "x" * i) for i in range(n)], "page_id long, url string, html string").coalesce(1)
        archives = warc.write_archives(pages, new_folder(spark, "warc"))
        with open(archives.first().path.removeprefix("file:"), "rb") as file:
            assert struct.unpack("<I", file.read(4))[0] == warc.DICTIONARY_FRAME
        assert sorted(r.payload_bytes for r in warc.read_archives(spark, archives).collect()) == list(range(n))


def test_the_query_writes_dictionaries(spark):
    from branchledger.llm.queries import QUERIES

    folder = pathlib.Path(shared_folder(spark).removeprefix("file:"))
    before = set(folder.glob("warc-*/*.warc.zst"))
    assert QUERIES["op2_warc"](spark, "/root/testdata/sf0.01").count() == 250
    archives = set(folder.glob("warc-*/*.warc.zst")) - before
    assert archives
    for path in archives:
        with open(path, "rb") as file:
            assert struct.unpack("<I", file.read(4))[0] == warc.DICTIONARY_FRAME


def test_reader_takes_archives_of_other_writers():
    import base64
    import io

    payload = b"<p>text</p>"
    sha1 = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html;\r\n charset=utf-8\r\n\r\n" + payload
    head = "WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:uuid:1>\r\nWARC-Date: 2020-01-01T00:00:00Z\r\nWARC-Payload-Digest: {}\r\nContent-Length: " + f"{len(block)}\r\n\r\n"
    for digest, fine in ((f"sha1:{sha1}", True), ("sha1:" + hashlib.sha1(payload).hexdigest(), True), ("sha1:" + "A" * 32, False), ("blake9:zz", True), ("md5:00", False)):
        data = head.format(digest).encode() + block + b"\r\n\r\n"
        if fine:
            got = warc.parse(data, "x")
            assert got["payload"] == payload and got["digest"] == hashlib.sha256(payload).hexdigest()
        else:
            with pytest.raises(warc.ArchiveError, match="digest"):
                warc.parse(data, "x")
    revisit = warc.record(2, None, b"long", "0" * 64, 1, "d").replace(b"sha256:" + b"0" * 64, b"sha1:abc").replace(b"Content-Length: 4\r\n", b"Server: x y\r\n")
    length = len(revisit.split(b"\r\n\r\n", 1)[1]) - 4
    revisit = re.sub(rb"(?<=response\r\nContent-Length: )\d+", b"%d" % length, revisit)
    got = warc.parse(revisit, "x")
    assert (got["type"], got["size"], got["digest"], got["refers_to"]) == ("revisit", None, "sha1:abc", "<urn:x-page:1>")
    data = head.format("x:y").encode() + block + b"\r\n\r\n"
    skip = struct.pack("<II", 0x184D2A53, 70_000) + b"s" * 70_000
    frame = zstandard.compress(data)
    stream = frame + skip + frame + struct.pack("<II", 0x184D2A5D, 0) + frame
    assert [d for _, d in warc.frames(io.BytesIO(stream), "x")] == [data] * 3
    assert [d for _, d in warc.frames(io.BytesIO(skip + stream), "x", buffer=7)] == [data] * 3
    with pytest.raises(warc.ArchiveError, match="more than"):
        list(warc.frames(io.BytesIO(frame), "x", most=50))
    with pytest.raises(warc.ArchiveError, match="cut short"):
        list(warc.frames(io.BytesIO(frame + skip[:-1]), "x"))


def test_reader_refuses_broken_archives(tmp_path):
    import io

    good = warc.record(1, "u", b"payload", hashlib.sha256(b"payload").hexdigest(), None, "d")
    assert warc.parse(good, "x")["payload"] == b"payload"
    for bad in (good[:-1], good.replace(b"WARC/1.1", b"WARC/9"), good.replace(b"payload\r\n", b"paylaod\r\n"), good.replace(b"WARC-Date", b"Date"), good.replace(b"Length: 7", b"Length: 8")):
        with pytest.raises(warc.ArchiveError):
            warc.parse(bad, "x")
    frame = zstandard.compress(good)
    assert len(list(warc.frames(io.BytesIO(frame * 3), "x"))) == 3
    empty = struct.pack("<II", warc.DICTIONARY_FRAME, 4) + b"none"
    for bad in (frame[:-3], frame + b"garbage", empty + frame):
        with pytest.raises(warc.ArchiveError):
            list(warc.frames(io.BytesIO(bad), "x"))


def test_quality_classifier_holds_out(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text"), spark.read.parquet(f"{folder}/labels.parquet")
    model = quality_classifier.train(docs, labels, remainder("doc_id", 3) != 1)
    rows = quality_classifier.score(docs, model).where(remainder("doc_id", 3) == 1).join(labels, "doc_id").select("score", "quality").collect()
    right = [(r.score >= 0.5) == (r.quality == 1) for r in rows]
    assert sum(right) > 0.95 * len(right)
    assert all(r.score >= 0.5 for r in rows if r.quality == 1) or sum(r.score < 0.5 for r in rows if r.quality == 1) < 0.02 * len(rows)


def test_quality_scores_by_brute_force():
    """Features from plain compressors, weights and score by the formula."""
    rng = random.Random(6)
    good = [" ".join(rng.choice(["river", "stone", "walks", "under", "slowly", "a", "the"]) for _ in range(80)).encode() for _ in range(60)]
    bad = [" ".join(rng.choice(["click", "buy", "now", "free", "!!!", "win"]) for _ in range(80)).encode() for _ in range(60)]
    f = quality_classifier.Fitting(dictionary_bytes=2048, block=100)
    model = quality_classifier.fit(good, bad, 0.5, f)
    texts = [b"", b"the river", *good[50:], *bad[50:], b"x" * 1000]
    got = model.scorer().scores(texts)
    for text, score in zip(texts, got):
        sizes = []
        for data in (model.good, model.bad):
            packer = zstandard.ZstdCompressor(level=f.level, dict_data=zstandard.ZstdCompressionDict(data), write_content_size=False)
            sizes.append(sum(len(packer.compress(text[a : a + 100])) for a in range(0, max(1, len(text)), 100)))
        a, b = sizes
        n = max(1, len(text))
        raw = [(b - a) / (a + b), (b - a) / n, a / n]
        x = [(min(max(v, lo), hi) - m) / s for v, lo, hi, m, s in zip(raw, model.low, model.high, model.mean, model.spread)]
        assert abs(score - 1 / (1 + np.exp(-(sum(w * v for w, v in zip(model.weights, x)) + model.weights[3])))) < 0.02
    assert got[2:12].min() > 0.9 and got[12:22].max() < 0.1


def test_quality_scores_of_odd_texts(spark, odd, odd_rows, empty):
    labels = spark.createDataFrame([(4, 1), (5, 0), (5, 1), (None, 1), (7, None)], "doc_id long, quality int")
    model = quality_classifier.train(odd, labels, F.lit(True))
    assert model.prior == 1.0 and not model.weights  # too few labels: the share of good ones
    fitted = quality_classifier.fit([f"plain words number {i} here".encode() * 9 for i in range(40)], [f"&&& {i} %%% ".encode() * 9 for i in range(40)], 0.5, quality_classifier.Fitting(dictionary_bytes=512))
    got = quality_classifier.score(odd, fitted).collect()
    assert len(got) == len(odd_rows) and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if not r.text}) == 1
    assert quality_classifier.score(empty, fitted).collect() == []


def test_language_of_odd_texts(spark, odd, odd_rows, empty):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    model = language_id.train(docs, remainder("doc_id", 5) != 0)
    held = language_id.identify(docs, model).where(remainder("doc_id", 5) == 0).collect()
    assert sum(r.lang == r.lang_pred for r in held) > 0.95 * len(held)
    got = language_id.identify(odd, model).collect()
    assert len(got) == len(odd_rows)
    for r in got:
        known = bool(r.text) and any(c.isalpha() for c in r.text)
        assert (r.lang_pred != "und") == known and 0 <= r.score <= 1
    assert language_id.identify(empty, model).collect() == []
    nothing = language_id.train(empty, F.lit(True))
    assert {r.lang_pred for r in language_id.identify(odd, nothing).collect()} == {"und"}


def test_kernel_by_brute_force():
    k = language_id.Kernel(lengths=(1, 2), landmarks=4)
    texts = ["abc abd", "xyz", "ab ab", "bca cab"]
    model = language_id.fit(texts, ["a", "b", "a", "a"], k)
    got = model.matrix(["abd xa", "zz"])

    def present(text, n):
        s = re.sub("[^a-z]+", " ", text) + " "
        return {s[i : i + n] for i in range(len(s) - n + 1)} - {" " * n}

    turn = ["abc abd", "xyz", "ab ab", "bca cab"]
    order = [turn[0], turn[1], turn[2], turn[3]]
    for i, x in enumerate(["abd xa", "zz"]):
        for j, y in enumerate(order):
            want = sum(len(present(x, n) & present(y, n)) / (len(present(x, n)) * len(present(y, n))) ** 0.5 for n in (1, 2)) / 2
            assert got[i, j] == pytest.approx(want, rel=1e-5)


def test_licences(spark, odd, odd_rows, empty):
    model = licenses.train(odd)
    rows = [
        (1, "word word\nLicensed under the Apache License, Version 2.0.\nmore"), (2, "Released under the MIT License. " + " ".join(f"q{i}" for i in range(400))),
        (3, "This work is licensed under the GNU General Public License, version 3."), (4, "The license of the version is under this work"), (5, None), (6, "Licensed under CC BY-NC 4.0.\n" * 2),
        (6, "Licensed under CC BY-NC 4.0.\n" * 2),
    ]
    got = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()
    assert Counter((r.doc_id, tuple(r.licences), tuple(r.licence_lines)) for r in got) == Counter(
        [(1, ("Apache-2.0",), (1,)), (2, ("MIT",), (0,)), (3, ("GPL-3.0",), (0,)), (4, (), ()), (5, (), ()), (6, ("CC-BY-NC-4.0",), (0, 1)), (6, ("CC-BY-NC-4.0",), (0, 1))]
    )
    assert len(licenses.scan(odd, model).collect()) == len(odd_rows) and not any(r.licences for r in licenses.scan(odd, model).collect())
    assert licenses.scan(empty, licenses.train(empty)).collect() == []


def test_licence_sample_of_any_number_of_rows(spark):
    for rows in (0, 1, 10**6, 2 * 10**10, 10**15):
        place = F.lit((1 << 30) - 1) / F.lit(1 << 30)
        kept = spark.range(1).where(place < licenses.share(2 * licenses.Scan().sample, rows)).count()
        assert kept == (rows <= 2 * licenses.Scan().sample)


def test_licence_templates_are_recognised():
    model = licenses.fit([], licenses.Scan())
    for family, own in licenses.TEMPLATES.items():
        for template in own:
            assert family in model.scan_texts([f"# {template}.".encode()])[0]["families"]


def test_licences_are_candidates_of_the_model(spark):
    """With fewer candidates than families nothing that the templates find is lost on whole documents.

    Recall and false reports: every document with a line of a template's very words reports its family,
    none without any word 3-gram of a template reports one.
    """
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    model = licenses.train(docs)
    texts = [r.text.encode() for r in docs.collect() if r.text]
    few = model.scan_texts(texts)
    every = dataclasses.replace(model, scan=dataclasses.replace(model.scan, candidates=len(licenses.TEMPLATES))).scan_texts(texts)
    assert [r["families"] for r in few] == [r["families"] for r in every] and any(r["families"] for r in few)
    none = dataclasses.replace(model, scan=dataclasses.replace(model.scan, candidates=0)).scan_texts(texts)
    assert not any(r["families"] for r in none) and all(a["unconfirmed"] >= b["unconfirmed"] for a, b in zip(none, few))
    grams = {tuple(w[i : i + 3]) for own in licenses.TEMPLATES.values() for t in own for w in [re.findall(r"[a-z0-9.]+", t.lower())] for i in range(len(w) - 2)}
    for text, row in zip(texts, few):
        plain = text.decode().lower()
        w = re.findall(r"[a-z0-9.]+", plain)
        held = [family for family, own in licenses.TEMPLATES.items() for t in own if t.lower() in plain and t.lower().count(" ") > 6]
        if len(set(held)) == 1:
            assert set(held) <= row["families"], plain
        if grams.isdisjoint(zip(w, w[1:], w[2:])):
            assert not row["families"], plain


def test_licences_two_notices_in_a_line():
    model = licenses.fit([], licenses.Scan())
    two = [
        (b"Released under the MIT License. Licensed under the Apache License, Version 2.0.", {"MIT", "Apache-2.0"}),
        (b"Licensed under the BSD 2-Clause License. Licensed under the BSD 3-Clause License.", {"BSD-2-Clause", "BSD-3-Clause"}),
        (" ".join(licenses.TEMPLATES["AGPL-3.0"][:1] + licenses.TEMPLATES["GPL-2.0"][1:]).encode(), {"AGPL-3.0", "GPL-2.0"}),
    ]
    for (text, families), row in zip(two, model.scan_texts([t for t, _ in two])):
        assert (row["families"], row["lines"], row["unconfirmed"]) == (families, [0], 0), text
    every = [t for own in licenses.TEMPLATES.values() for t in own]
    assert model.scan_texts([". ".join(every).encode()])[0]["families"] == set(licenses.TEMPLATES)


def test_licences_wrapped_over_lines():
    import textwrap

    model = licenses.fit([], licenses.Scan())
    for family, own in licenses.TEMPLATES.items():
        for template in own:
            for width, mark in ((72, ""), (30, "# "), (40, " * "), (50, "// ")):
                lines = [mark + x for x in textwrap.wrap(template + ".", width, break_on_hyphens=False)]
                row = model.scan_texts(["\n".join(["int main", "", *lines, "", "more words"]).encode()])[0]
                assert (row["families"], row["lines"]) == ({family}, list(range(2, 2 + len(lines)))), (template, width, row)
                assert row["unconfirmed"] == 0
    short, apart, tie = model.scan_texts([
        b"Released under the\nMIT License", b"Released under the\n\nMIT License",
        b"This program is free software: you can redistribute it and/or modify",
    ])
    assert short["families"] == {"MIT"} and short["lines"] == [0, 1] and not apart["families"]
    assert not tie["families"] and tie["unconfirmed"] == 1
    among = b"one two three four\nReleased under the MIT License.\nfive six seven " + b"word " * 300
    assert (row := model.scan_texts([among])[0])["families"] == {"MIT"} and row["lines"] == [1]


def test_empty_tables(empty):
    assert packing.packed(empty, TOKENS).collect() == [] and quality_rules.quality_rules(empty).collect() == []
    assert bpe.decode(bpe.encode(empty, RANKS, P.PATTERN), RANKS, P.PATTERN).collect() == []
