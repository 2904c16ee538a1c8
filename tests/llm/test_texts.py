"""Languages, quality, tokens and pieces on whole texts, by brute force or the libraries themselves."""

from __future__ import annotations

import hashlib
import math
import random
import re
import string
import time
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2 as model_pb2
from tokenizers import Tokenizer

from martloom.llm import languages, pieces, quality, registry, token_shards, words
from martloom.llm.common import text_blocks

FOLDER = "/root/testdata/sf0.1"
BYTES = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", " ", "a", "a  b ", "\n\n x\u3000y", "x<|endoftext|> y  z", "\x1c a", "é😀" * 50, "don't we're I'll"]
ODD += ["a.b,c. d .e f,, g... h\n.i\nj\n\nk 3.5,6\n", ".a b\nc", "\na b.", "x.\ny it's.z", "ä.Ω. ß,"]
ODD += ["a_.b c", "a b ", "Ω.x y", "²,x y", "1,2\n3 4.", "\u00a0.x y\u00a0\nz", "x\u2028.y z"]


# Words and hashes


def test_words_and_shingles_equal_plain_splitting():
    texts = ["", " a  b\tc ", "one", "é ñ é ñ é", "x" * 5000, "\n", "a b a b a b"]
    batch = pa.RecordBatch.from_pydict({"text": [*texts, None]})
    seen: dict[bytes, int] = {}
    for most in (1, 8, 1 << 20):
        at = 0
        for _, data, offsets in text_blocks(iter([batch]), "text", most):
            begins, ends, bounds = words.word_spans(data, offsets)
            hashes = words.word_hashes(data, begins, ends)
            for row in range(len(offsets) - 1):
                text = ([*texts, None][at] or "").encode()
                plain = [w for w in re.split(rb"[ \t-\r]+", text) if w]
                span = range(bounds[row], bounds[row + 1])
                assert [data[begins[i] : ends[i]].tobytes() for i in span] == plain
                for word, i in zip(plain, span, strict=True):
                    assert seen.setdefault(word, int(hashes[i])) == int(hashes[i])
                at += 1
            for width in (1, 2, 3):
                found, of = words.shingle_hashes(hashes, bounds, width)
                assert len(found) == of[-1]
    assert len(set(seen.values())) == len(seen)


# Languages


def test_held_out_languages(spark):
    rows = registry.op1_language_codes(spark, FOLDER).collect()
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    held = [row for row in rows if row.held_out]
    assert {row.held_out for row in rows} == {True, False} and len(rows) == len(truth)
    assert all(row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 5 == 0) for row in rows)
    assert np.mean([row.lang_pred == truth[row.doc_id] for row in held]) > 0.97
    assert all(0 <= row.score <= 1 for row in rows)


def plain_languages(training, texts):
    """Languages and scores in plain Python: the hash, the codewords and the constants are shared."""
    fold = lambda b: b | 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32

    def buckets(text):
        raw = [fold(b) for b in text.encode()]
        joined = [raw[at] << 16 | raw[at + 1] << 8 | raw[at + 2] for at in range(len(raw) - 2)]
        return [(j * 0x9E3779B1 & 0xFFFFFFFF) >> 17 for j in joined if j != 0x202020]

    names = sorted({lang for lang, text in training if lang is not None and text is not None and buckets(text)})
    rates = []
    for name in names:
        counts = [languages.SMOOTHING] * languages.BUCKETS
        for lang, text in training:
            for bucket in buckets(text) if lang == name and text is not None else []:
                counts[bucket] += 1
        rates.append([n / sum(counts) for n in counts])
    code = languages.codebook(len(names)).tolist()
    weights, trust = [], []
    for bit in range(len(code[0])):
        sides = [[r for r, c in zip(rates, code, strict=True) if c[bit] == s] for s in (1, -1)]
        up, down = [[sum(x) / len(side) for x in zip(*side, strict=True)] for side in sides]
        weights.append([math.log(a / b) for a, b in zip(up, down, strict=True)])
        own = [
            sum(a * b for a, b in zip(r, weights[-1], strict=True)) * c[bit]
            for r, c in zip(rates, code, strict=True)
        ]
        trust.append(max(min(own), 1e-3))
    found = []
    for text in texts:
        if not any(c.isalpha() for c in text or ""):
            found.append(("und", 0.0))
            continue
        held = buckets(text)
        margins = [sum(w[b] for b in held) / max(len(held), 1) for w in weights]
        losses = [
            sum(
                t / sum(trust) * len(trust) * math.log1p(math.exp(-languages.SHARPNESS * m * bit))
                for t, m, bit in zip(trust, margins, word, strict=True)
            )
            for word in code
        ]
        shares = [math.exp(min(losses) - loss) for loss in losses]
        found.append((names[losses.index(min(losses))], max(shares) / sum(shares)))
    return found


def test_languages_equal_plain_python(spark, documents, monkeypatch):
    monkeypatch.setattr(languages, "EXHAUSTIVE", 5)  # so that there are codes of both kinds
    rows = documents.select("doc_id", "lang", F.substring("text", 1, 400).alias("text")).limit(40)
    odd = [(-1, "xx", "ab"), (-2, "xx", None), (-3, None, "a text"), (-4, "yy", "été ñandú é")]
    rows = rows.unionAll(spark.createDataFrame(odd, "doc_id long, lang string, text string"))
    held = sorted((r.doc_id, r.lang, r.text) for r in rows.collect())
    model = languages.learned(rows)
    found = languages.identified(rows, model, rows.doc_id).collect()
    found = {r.doc_id: (r.lang_pred, r.score) for r in found}
    expected = plain_languages([row[1:] for row in held], [text for *_, text in held])
    for (name, *_), (lang, score) in zip(held, expected, strict=True):
        assert found[name][1] == pytest.approx(score, rel=1e-4)
        assert found[name][0] == lang or score < 0.5


def test_very_many_languages(spark):
    """8,000 languages: what the driver holds and does is bounded by codewords."""
    rows = spark.range(8_000).selectExpr(
        "id AS doc_id", "concat('l', id % 8000) AS lang",
        "concat_ws(' ', transform(sequence(0, 30), n -> substr(sha1(concat(id % 8000, '-', n)), 1, 6)))"
        " AS text",
    )
    begin = time.perf_counter()
    model = languages.learned(rows)
    assert time.perf_counter() - begin < 90
    assert len(model.languages) == 8000 == len(np.unique(model.code, axis=0))
    assert model.code.shape[1] == 130
    assert model.weights.shape == (languages.BUCKETS + 1, 130)
    some = rows.limit(20)
    found = languages.identified(some, model, some.doc_id).collect()
    assert {row.lang_pred for row in found} <= set(model.languages) and len(found) == 20


def test_languages_of_odd_documents(odd_documents, no_documents):
    model = languages.learned(odd_documents)
    found = languages.identified(odd_documents, model, odd_documents.doc_id, odd_documents.text)
    for row in found.collect():
        letters = any(c.isalpha() for c in row.text or "")
        assert (row.lang_pred == "und") == (not letters)
        assert letters or row.score == 0
    empty = languages.learned(no_documents)
    found = languages.identified(odd_documents, empty, odd_documents.doc_id).collect()
    assert {row.lang_pred for row in found} == {"und"}
    assert languages.identified(no_documents, model, no_documents.doc_id).count() == 0


@pytest.mark.parametrize("count", [1, 2, 4, 7, 12])
def test_codewords_differ_and_every_bit_parts_them(count):
    code = languages.codebook(count)
    assert len({tuple(row) for row in code}) == count
    assert (np.abs(code.sum(0)) < count).all()
    apart = (code.shape[1] - code @ code.T) / 2
    assert count < 3 or (apart + np.eye(count) * 99).min() >= code.shape[1] / 4


def test_trigrams_never_span_two_texts():
    batch = pa.RecordBatch.from_pydict({"text": ["abc", "d", "", "ef", "ghij"]})
    ((_, data, offsets),) = text_blocks(iter([batch]), "text")
    code = languages.trigrams(data, offsets)
    assert [int((code[a:b] < languages.BUCKETS).sum()) for a, b in zip(offsets, offsets[1:])] == [
        1, 0, 0, 0, 2,
    ]


# Quality


def test_held_out_quality(spark):
    rows = {row.doc_id: row for row in registry.op5_preference_ranking(spark, FOLDER).collect()}
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").collect()
    held = [x for x in labels if x.doc_id in rows and rows[x.doc_id].held_out]
    right = [rows[x.doc_id].predicted == x.quality for x in held]
    assert np.mean(right) > 0.97
    assert all(row.predicted == int(row.score >= 0.7) for row in rows.values())
    assert all(0 <= row.score <= 1 for row in rows.values())
    assert all(r.held_out == (zlib.crc32(str(n).encode()) % 4 == 2) for n, r in rows.items())


def test_quality_of_odd_documents(spark, odd_documents, no_documents):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    model = quality.learned(odd_documents, labels)
    found = quality.scored(odd_documents, model, odd_documents.doc_id)
    assert found.count() == odd_documents.count()
    assert all(0 <= row.score <= 1 for row in found.collect())
    untrained = quality.learned(odd_documents, labels.limit(0))
    scores = {row.score for row in quality.scored(odd_documents, untrained).collect()}
    assert scores == {quality.AT_THRESHOLD}
    assert quality.learned(no_documents, labels).threshold == 0
    assert quality.scored(no_documents, model).count() == 0


def test_features_do_not_depend_on_the_block():
    texts = ["One two. Two one!", "", "a | b | c", "X" * 300, "é ñ\nline\nline\n"]
    batch = pa.RecordBatch.from_pydict({"text": texts})
    parts = [
        np.concatenate([quality.features(d, o) for _, d, o in text_blocks(iter([batch]), "text", n)])
        for n in (1, 1 << 20)
    ]
    assert np.allclose(*parts)


def plain_features(text):
    """The features of a text, counted one by one."""
    raw = text.encode()

    def kind(byte):
        if byte == 10:
            return 1
        if byte == 32 or 9 <= byte <= 13:
            return 0
        for n, known in ((2, string.ascii_lowercase), (3, string.ascii_uppercase), (4, string.digits)):
            if chr(byte) in known and byte < 128:
                return n
        return 5 if chr(byte) in ".,;:?" else 6 if byte < 128 else 7

    kinds = [sum(kind(b) == n for b in raw) / max(len(raw), 1) for n in range(8)]
    found = [w for w in re.split(rb"[ \t-\r]+", raw) if w]
    n = max(len(found), 1)
    of = lambda word, *wanted: sum(kind(b) in wanted for b in word)
    share = lambda holds: sum(map(holds, found)) / n
    mean = sum(map(len, found)) / n
    spread = max(sum(len(w) ** 2 for w in found) / n - mean**2, 0)
    pairs = list(zip(found, found[1:], strict=False)) if len(found) > 1 else [tuple(found)][: len(found)]
    lines = [line for line in raw.split(b"\n") if line]
    variety = lambda x: len(set(x)) / len(x) if x else 1.0
    commonest = lambda x: max(map(x.count, x)) / len(x) if x else 0.0
    return [
        *kinds,
        *[math.sqrt(k) for k in kinds],
        kinds[3] / max(kinds[2] + kinds[3], 1e-9),
        share(lambda w: not of(w, 2, 3, 7)),
        share(lambda w: of(w, 3) == of(w, 2, 3, 7) > 1),
        share(lambda w: of(w, 6) > 0),
        share(lambda w: of(w, 6) > 0 < of(w, 2, 3, 7)),
        share(lambda w: of(w, 4) > 0 < of(w, 2, 3, 7)),
        math.log1p(mean),
        math.log1p(math.sqrt(spread)),
        math.log1p(len(found)),
        variety(found), commonest(found), variety(pairs), commonest(pairs), variety(lines),
        math.log1p(len(found) / max(len(lines), 1)),
        float(not found),
    ]


def test_features_equal_plain_python(documents):
    texts = [(row.text or "")[:3000] for row in documents.limit(40).collect()]
    texts += [*ODD, "a a a b", "A1 b2, C|d", "\n\nx\n\nx\n", "ÄÖ äö"]
    batch = pa.RecordBatch.from_pydict({"text": texts})
    ((_, data, offsets),) = text_blocks(iter([batch]), "text", 1 << 30)
    found = quality.features(data, offsets)
    expected = np.array([plain_features(text) for text in texts])
    assert found.shape == expected.shape and np.allclose(found, expected, atol=1e-6)


def test_weights_minimise_the_loss_of_the_pairs(monkeypatch):
    monkeypatch.setattr(quality, "PAIRS", 400)
    draw = np.random.default_rng(5)
    width = len(plain_features(""))
    better, worse = draw.normal(0.4, 1, (60, width)), draw.normal(0, 1, (50, width))
    model = quality.fitted(better, worse, 0.5)
    both = np.concatenate([better, worse])
    scale = lambda rows: ((rows - both.mean(0)) / both.std(0)).clip(-10, 10)
    random_pairs = np.random.default_rng(0)
    one, two = random_pairs.integers(0, 60, 400), random_pairs.integers(0, 50, 400)

    def loss(weights):
        gaps = [scale(better)[a] - scale(worse)[b] for a, b in zip(one, two, strict=True)]
        fit = sum(math.log1p(math.exp(-float(gap @ weights))) for gap in gaps) / 400
        return fit + quality.RIDGE / 2 * float(weights @ weights)

    least = loss(model.weights)
    for _ in range(30):
        assert loss(model.weights + draw.normal(0, 0.05, width)) > least
    up, down = model.latent(better), model.latent(worse)
    right = lambda t: (up >= t).mean() + (down < t).mean()
    tried = np.quantile(np.concatenate([up, down]), np.arange(1, 200) / 200)
    assert right(model.threshold) >= max(map(right, tried)) - 0.03
    assert np.allclose(model.scores(better) >= 0.7, up >= model.threshold)


def labelled(spark, n, seed=7):
    """``n`` documents of words and marks, and labels that both kinds of documents have."""
    draw = np.random.default_rng(seed)
    docs, labels = [], []
    for at in range(n):
        good = int(draw.random() < 0.4)
        word = lambda p: "ab1 " if draw.random() < p else "Some words, "
        p = draw.beta(2, 4) if good else draw.beta(4, 2)
        docs.append((at, "".join(word(p) for _ in range(draw.integers(3, 30)))))
        labels.append((at, good))
    return (
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(labels, "doc_id long, quality int"),
    )


def test_fit_sees_all_labelled_documents_and_all_their_pairs(spark):
    """The least loss over all pairs, and the best threshold of all scores, from whatever start."""
    docs, labels = labelled(spark, 300)
    model = quality.learned(docs, labels, 10)
    other = quality.learned(docs, labels, 60)
    assert np.allclose(model.weights, other.weights, atol=2e-3)
    text = {row.doc_id: row.text for row in docs.collect()}
    mark = {row.doc_id: row.quality for row in labels.collect()}
    rows = np.array([plain_features(text[n]) for n in sorted(text)])
    good = np.array([mark[n] for n in sorted(text)]) == 1
    assert np.allclose(model.center, rows.mean(0)) and np.allclose(
        model.scale, np.maximum(rows.std(0), 1e-6), atol=1e-6
    )
    own = model.standard(rows)

    def slope(weights):
        scores = own @ weights
        lost = 1 / (1 + np.exp(scores[good][:, None] - scores[~good]))
        fall = lost.sum(1) @ own[good] - lost.sum(0) @ own[~good]
        return quality.RIDGE * weights - fall / lost.size

    assert np.abs(slope(model.weights)).max() < 1e-4
    up, down = model.latent(rows[good]), model.latent(rows[~good])
    right = lambda t: (up >= t).mean() + (down < t).mean()
    scores = np.sort(np.concatenate([up, down]))
    assert right(model.threshold) >= max(map(right, scores)) - 1e-9


def test_repeated_labelled_documents_count_once(spark):
    """A doc_id with several texts counts with the smallest, with several labels with the lowest."""
    docs, labels = labelled(spark, 80)
    more = docs.where("doc_id < 9").unionAll(
        docs.where("doc_id < 5").selectExpr("doc_id", "concat(text, 'zz ZZ !!') AS text")
    )
    twice = labels.where("doc_id < 20").unionAll(labels.where("quality = 0").selectExpr("doc_id", "1"))
    one, two = quality.learned(docs, labels), quality.learned(
        docs.unionAll(more), labels.unionAll(twice)
    )
    assert np.array_equal(one.weights, two.weights) and one.threshold == two.threshold


# Tokens


def test_chunks_encode_as_the_library_does(documents):
    encoder = token_shards.ChunkEncoder(BYTES)
    assert encoder.in_chunks
    drawn = random.Random(1)
    signs = [*" .,\na1Ω_!\t\r\u00a0\u0301😀", "  ", "é", "'s", "b c", "x.y", "<|endoftext|>"]
    mixed = ["".join(drawn.choices(signs, k=drawn.randrange(1, 25))) for _ in range(20_000)]
    texts = ODD + mixed + [row.text or "" for row in documents.collect()]
    whole = Tokenizer.from_file(BYTES)
    expected = [whole.encode(text, add_special_tokens=False).ids for text in texts]
    rows = pa.array(texts, pa.large_string())
    for _ in range(2):
        assert [list(ids) for ids in encoder(rows)] == expected
    assert encoder(rows[:0]) == []


@pytest.mark.parametrize("highest", [1, 2, 300, 50_256, 90_000])
def test_wavelet_shard_answers_as_the_ids_do(highest):
    ids = np.random.default_rng(1).integers(0, highest, 5000).astype("<u4")
    shard = token_shards.WaveletShard(token_shards.WaveletShard.build(ids, [3, None], [4000, 1000]))
    assert np.array_equal(shard.tokens(), ids)
    assert shard.doc_lengths.tolist() == [4000, 1000] and shard.missing.tolist() == [False, True]
    drawn = random.Random(2)
    for place in [0, 4999, *(drawn.randrange(5000) for _ in range(60))]:
        token = int(ids[place])
        assert shard.access(place) == token
        assert shard.rank(token, place) == (ids[:place] == token).sum()
        assert shard.count(token) == (ids == token).sum()
        assert shard.select(token, shard.rank(token, place)) == place
    assert shard.count(1 << 20) == 0
    for bad in (lambda: shard.access(5000), lambda: shard.select(int(ids[0]), 5000)):
        with pytest.raises(IndexError):
            bad()
    with pytest.raises(ValueError, match="not a token shard"):
        token_shards.WaveletShard(b"nothing")


@pytest.mark.parametrize("shard_tokens", [200, 1 << 20])
def test_shards_read_back(odd_documents, no_documents, shard_tokens):
    files = token_shards.shards(odd_documents, BYTES, shard_tokens).persist()
    starts = token_shards.shard_starts(files.drop("blob"))
    found = token_shards.document_digests(files.join(starts.drop("n_tokens"), ["part", "number"]))
    rows = sorted(found.collect(), key=lambda row: row.start)
    encoder = Tokenizer.from_file(BYTES)
    expected = []
    for row in odd_documents.collect():
        ids = encoder.encode(row.text or "", add_special_tokens=False).ids + [2]
        expected.append((row.doc_id, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    key = lambda x: (x[0] is not None, x[0] or 0, x)
    assert sorted([(r.doc_id, r.n_tokens, r.ids_crc32) for r in rows], key=str) == sorted(expected, key=str)
    assert [r.start for r in rows] == np.cumsum([0, *[r.n_tokens for r in rows]])[:-1].tolist()
    ids = [key((r.doc_id,))[:2] for r in rows]
    assert ids == sorted(ids)
    assert token_shards.written(no_documents, BYTES).count() == 0


# Pieces


def test_pieces_equal_the_library(odd_documents, no_documents):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    expected = []
    for row in odd_documents.collect():
        ids = library.encode(row.text or "")
        expected.append(
            (row.doc_id, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids)))
        )
    found = pieces.digests(odd_documents, PIECES)
    assert sorted([tuple(r)[:4] for r in found.collect()], key=str) == sorted(expected, key=str)
    lengths = {r.doc_id: len((r.text or "").encode()) for r in odd_documents.collect() if r.doc_id}
    assert all(r.covered == lengths[r.doc_id] for r in found.collect() if r.doc_id)
    assert pieces.digests(no_documents, PIECES).count() == 0


def test_spans_of_pieces(odd_documents):
    out = pieces.encoded(odd_documents, PIECES)
    assert out.columns[-4:] == list(pieces.RESULTS)
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    for row in out.collect():
        raw = (row.text or "").encode()
        assert row.ids == library.encode(row.text or "")
        assert row.begins == sorted(row.begins) and row.ends == sorted(row.ends)
        for piece, a, b in zip(row.ids, row.begins, row.ends, strict=True):
            said = library.id_to_piece(piece)
            if not library.is_byte(piece):
                spaced = said.replace("▁", " ")  # the first of all is put before the text
                assert raw[a:b].decode() in (spaced, spaced[1:])


def compiled(entries: dict[bytes, bytes]) -> bytes:
    """A character map with the given entries, laid out as a double array."""
    units, replacements, places = {0: 0}, b"", {}
    for key, put in entries.items():
        places[key] = len(replacements)
        replacements += put + b"\0"
    bases: list[int] = []

    def lay(node: int, prefix: bytes) -> None:
        labels = sorted({key[len(prefix)] for key in entries if key.startswith(prefix) and key != prefix})
        leaf = prefix in entries
        base = 256 * (1 + len(bases))
        bases.append(base)
        units[node] |= ((node ^ base) << 10) & 0x7FFFFC00
        if leaf:
            units[node] |= 1 << 8
            units[base] = places[prefix] | 1 << 31
        for label in labels:
            units[base ^ label] = label
        for label in labels:
            lay(base ^ label, prefix + bytes([label]))

    lay(0, b"")
    array = np.zeros(max(units) + 1, "<u4")
    for at, unit in units.items():
        array[at] = unit
    raw = array.tobytes()
    return len(raw).to_bytes(4, "little") + raw + replacements


def test_longest_prefix_and_alignment():
    model = model_pb2.ModelProto()
    model.normalizer_spec.precompiled_charsmap = compiled(
        {"ﬁ".encode(): b"fi", b"ab": b"X", b"abc": b"YZ", "Ａ".encode(): b"A"}
    )
    model.normalizer_spec.add_dummy_prefix = True
    model.normalizer_spec.escape_whitespaces = True
    model.normalizer_spec.remove_extra_whitespaces = False
    normalise = pieces.Normaliser(model)
    text = "ﬁ abcd abx Ａé".encode()
    aligned = normalise(text)
    assert aligned.text.decode() == "▁fi▁YZd▁Xx▁Aé"
    assert len(aligned.source) == len(aligned.text) + 1 and aligned.source[-1] == len(text)
    at = aligned.text.index(b"YZ")
    assert aligned.source[at : at + 3].tolist() == [4, 4, 7]
    model.normalizer_spec.remove_extra_whitespaces = True
    assert pieces.Normaliser(model)(b"  a   b  ").text.decode() == "▁a▁b"
    assert pieces.Normaliser(model)(b"   ").text == b""
    assert pieces.Normaliser(model)(b"").text == b""
