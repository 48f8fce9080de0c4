import base64
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from tokenizers import Tokenizer

from hivelens.llm import bitplane, media_ts
from hivelens.llm.bpe_tree import Encoder, bpe_encode
from hivelens.llm.pii import find_pii, pii_digest, redact
from hivelens.llm.token_counts import count_tokens, write_flat
from hivelens.llm.token_files import WordEncoder
from tests.llm.fixtures import TEXTS, empty, frame

RANKS, WORDS = P.path("byte_bpe_50k.tiktoken"), P.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def plain():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("t", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_tree_equals_plain_encoding(plain):
    signs = ["a", "b", " ", "  ", "\n", "'re", "'s", "'", "é", "ß", "中", "1", "23", "!", "\t", "xx" * 20, " the", "😀", "\r\n", "\x1c", "\x85", "　"]
    rng = random.Random(5)
    for leaf in (1, 2, 7, 40):
        enc = Encoder(RANKS, P.PATTERN, leaf)
        for _ in range(300):
            text = "".join(rng.choice(signs) for _ in range(rng.randint(0, 100)))
            ids = enc.encode(text)
            assert ids == plain.encode_ordinary(text), repr(text)
            assert enc.decode(ids) == text.encode()


@pytest.mark.parametrize("letters", ["a", "abcdefgh", "éàñabß", "!?*#-", "0123456789", "中文字", " ", "\n "])
def test_tree_in_long_runs(plain, letters):
    rng = random.Random(7)
    text = "".join(rng.choice(letters) for _ in range(20_000))
    assert Encoder(RANKS, P.PATTERN, 512).encode(text) == plain.encode_ordinary(text)


def test_bpe_frame(spark, plain):
    rows = bpe_encode(frame(spark), RANKS, P.PATTERN).collect()
    assert len(rows) == len(TEXTS)
    for r in rows:
        ids = plain.encode_ordinary(r["text"] or "")
        assert r["ids"] == ids and r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256((r["text"] or "").encode()).hexdigest()
    assert bpe_encode(empty(spark), RANKS, P.PATTERN).count() == 0


@pytest.fixture(scope="module")
def by_library():
    t = Tokenizer.from_file(WORDS)
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def test_word_encoder_equals_library(by_library):
    texts = [t or "" for t in TEXTS] + ["a\x1cb c", "Σίσυφος ΟΔΟΣ", "é <|endoftext|>x", "İstanbul x\u0085y"]
    assert [list(x) for x in WordEncoder(WORDS).encode_texts(texts)] == [by_library(t) for t in texts]


def test_word_encoder_in_odd_signs(by_library):
    encoder, rng = WordEncoder(WORDS), random.Random(4)
    signs = [*"aTJWHYabz.,'!?1", " ", "  ", "\t", "\n", "\x0b", "\x1c", "\x85", "\xa0", "\u2003", "\u0308", "\u030c", "\u030a", "\u0331", "\u0301", "İ", "ß", "Σ", "ς", "中", "가", "ᄀ", "ᅡ", "'s", "'LL", "n't", "<|endoftext|>", "<|", "|>", "<|startoftext|>", "😀", "é", "e\u0301", "\u0344", "\u212b", "\x00"]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 40))) for _ in range(4000)]
    assert [list(x) for x in encoder.encode_texts(texts)] == [by_library(t) for t in texts]
    for upper in "ATZ":  # each sign between capitals
        points = [f"{upper}{chr(c)}{upper} {chr(c)}{upper}{chr(c)}" for c in range(0x10000) if not 0xD800 <= c < 0xE000]
        assert [list(x) for x in encoder.encode_texts(points)] == [by_library(t) for t in points]


@pytest.mark.parametrize("kind", ["bit", "byte"])
def test_planes_round_trip(kind):
    rng = np.random.default_rng(1)
    for n, top in ((0, 1), (1, 1), (7, 2), (1000, 50_000), (65_536, 2**32)):
        ids = rng.integers(0, top, n, dtype=np.uint64).astype(np.uint32)
        assert (bitplane.join_planes(bitplane.split_planes(ids, kind), n, kind) == ids).all()


@pytest.mark.parametrize("kind", ["bit", "byte"])
def test_bitplane_files(spark, by_library, kind):
    manifest = bitplane.write_bitplanes(frame(spark), WORDS, 2, kind)
    order = sorted(((i if i != 3 else None, t or "") for i, t in enumerate(TEXTS)), key=lambda r: (r[0] is not None, r[0] or 0))
    start, expect = 0, []
    for i, t in order:
        ids = [*by_library(t), 2]
        expect.append((i, start, ids))
        start += len(ids)
    key = lambda r: r[1]
    assert sorted(((r.doc_id, r.start, r.ids) for r in bitplane.read_bitplanes(manifest).collect()), key=key) == expect
    digests = sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in bitplane.bitplane_digests(manifest).collect()), key=key)
    assert digests == [(i, s, len(x), zlib.crc32(np.array(x, dtype="<u4").tobytes())) for i, s, x in expect]
    assert bitplane.write_bitplanes(empty(spark), WORDS, 2).count() == 0


@pytest.mark.parametrize("block", [1, 3, 64, 1 << 20])
def test_separator_scan(spark, by_library, block):
    docs = frame(spark) if block > 3 else frame(spark).where("length(coalesce(text, '')) < 200")
    files, places = write_flat(docs, WORDS, 65_535)
    got = count_tokens(files, 65_535, block).join(places, ["shard", "ordinal"]).collect()
    expect = sorted((i if i != 3 else -1, len(by_library(t))) for i, t in enumerate(TEXTS) if block > 3 or len(t or "") < 200)
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_tokens) for r in got) == expect
    for shard in {r.shard for r in got}:
        rows = sorted((r.ordinal, r.start, r.n_tokens) for r in got if r.shard == shard)
        assert [r[1] for r in rows] == [sum(x[2] + 1 for x in rows[:k]) for k in range(len(rows))]
    empty_files, _ = write_flat(empty(spark), WORDS, 65_535)
    assert count_tokens(empty_files, 65_535).count() == 0


def test_transport_stream_round_trip():
    rng = random.Random(3)
    for n in [0, 1, 191, 192, 193, *(rng.randrange(60_000) for _ in range(40)), 12_288, 12_289, 300_000]:
        payload = media_ts.padded(rng.randbytes(n))
        media = media_ts.mux(payload)
        s = media_ts.demux(media)
        assert s.payload == payload and s.counter_errors == 0 and len(media) % 188 == 0
        assert s.units == len(s.pts) == len(s.random_access) == -(-len(payload) // media_ts.AU_BYTES)
    assert media_ts.crc32_mpeg(b"123456789") == 0x0376E6E7


def test_transport_stream_faults():
    media = media_ts.mux(b"a" * 192 * 300)
    assert media_ts.demux(media).counter_errors == 0
    with pytest.raises(ValueError):
        media_ts.demux(media[: 188 * 5] + media[188 * 6 :])
    with pytest.raises(ValueError):
        media_ts.demux(media[:100])
    with pytest.raises(ValueError):
        media_ts.demux(media[:20] + b"\x01" + media[21:])


def test_media_frame(spark):
    rows = media_ts.media_features(media_ts.encode_media(frame(spark))).collect()
    assert len(rows) == len(TEXTS)
    for r in rows:
        payload = media_ts.padded((r["text"] or "").encode())
        assert (r["n_bytes"], r["payload_bytes"]) == (len((r["text"] or "").encode()), len(payload))
        assert r["payload_sha256"] == hashlib.sha256(payload).hexdigest() and r["tail_crc32"] == zlib.crc32(payload[-16:])
        assert r["media_sha256"] == hashlib.sha256(r["media"]).hexdigest() and r["media_bytes"] == len(r["media"])
    assert media_ts.media_features(media_ts.encode_media(empty(spark))).count() == 0


def luhn_ok(d):
    total = 0
    for k, c in enumerate(reversed(d)):
        v = int(c) * (1 + k % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


PLAIN = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(d := re.sub("[^0-9]", "", m)) <= 19 and luhn_ok(d)),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(re.sub("[^0-9]", "", m)) <= 15),
}


def plain_spans(text):
    return [(k, m.start(), m.end()) for k, (p, ok) in PLAIN.items() for m in re.finditer(p, text) if ok(m.group())]


def test_pii_against_plain_patterns(spark):
    rng = random.Random(11)
    bits = ["a", "b.c", "@", "x@y.z", ".", "_", "%", "1", "23", "4.5", "192.168.0.1", " ", "-", "+1", "+44 20", "(", ")", "4111 1111 1111 1111", "4111-1111-1111-1111", "é", "😀", "0" * 5, "card "]
    texts = [*TEXTS, *("".join(rng.choice(bits) for _ in range(rng.randint(1, 30))) for _ in range(400))]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in pii_digest(df).collect():
        spans = plain_spans(texts[r.doc_id] or "")
        said = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert r.base_sha256 == hashlib.sha256(said.encode()).hexdigest(), (texts[r.doc_id], said, r.spans)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in spans) for k in PLAIN]
        assert set(said.split(",")) - {""} <= set(r.spans.split(","))


def test_pii_extra_spans_scores_and_redaction(spark):
    found = {r.doc_id: r for r in find_pii(frame(spark)).select("doc_id", "text", "pii", "lang").collect()}
    inside = [s for s in found[7].pii if not s.plain]
    assert [s.value for s in inside] == ["4918187128635271"]
    assert [s.value for s in found[8].pii if s.kind == "iban"] == ["GB82 WEST 1234 5698 7654 32"]
    scores = {s.kind: s.score for s in found[6].pii}
    assert scores["email"] == 1.0 and scores["phone"] == 0.6 and scores["ip"] == 0.8
    hidden = {r.doc_id: r.text for r in redact(frame(spark)).collect()}
    assert hidden[6] == "Write to [EMAIL] or [PHONE], host [IP] and 10.0.0.256."
    assert hidden[0] is None and hidden[1] == "" and hidden[4] == TEXTS[4]
    assert "[CARD]" in hidden[7] and "4918187128635271" not in hidden[7]
    assert find_pii(empty(spark)).count() == redact(empty(spark)).count() == 0


def test_pii_words_nearby_admit_a_kind_without_checksum(spark):
    texts = ["My SSN is 219-09-9999.", "Part 219-09-9999 ships.", "SSN 000-12-3456, 666-12-3456, 900-12-3456, 123-00-4567, 123-45-0000", "social security: 219-09-9999-1", "classn 219-09-9999"]
    rows = find_pii(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()
    assert [[(s.kind, s.start, s.end, s.score, s.plain) for s in r.pii] for r in rows] == [[("ssn", 10, 21, 0.6, False)], [], [], [], []]
    low = find_pii(spark.createDataFrame([(1, texts[1])], "doc_id long, text string"), min_score=0.0).first()
    assert [(s.kind, s.score) for s in low.pii] == [("ssn", 0.4)]


def test_pii_places_of_very_many_spans(spark):
    for n in (255, 256, 257, 3000):
        text = "".join(f"é a{i}@b.c," for i in range(n))
        spans = find_pii(spark.createDataFrame([(1, text)], "doc_id long, text string")).first().pii
        assert [(s.start, s.end) for s in spans] == [m.span() for m in re.finditer(r"a\d+@b\.c", text)]


def test_redaction_against_a_plain_one(spark):
    rng = random.Random(5)
    bits = ["x@y.z", "card 4111 1111 1111 1111", "1 4111 1111 1111 1111", "192.168.0.1", "+44 20 7946 0958", "é😀", " ", ", ", "SSN 219-09-9999", "0"]
    texts = ["".join(rng.choice(bits) for _ in range(n)) for n in [1, 5, 40] * 20 + [3000, 6000]] + ["a@b.c " * 256, "a@b.c " * 257, "", None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    hidden = {r.doc_id: r.text for r in redact(df).collect()}
    for r in find_pii(df).collect():
        out, at = [], 0
        for s in sorted(r.pii, key=lambda s: (s.start, -s.end)):
            if s.start >= at:
                out.append(r.text[at : s.start] + f"[{s.kind.upper()}]")
            at = max(at, s.end)
        assert hidden[r.doc_id] == (None if r.text is None else "".join(out) + r.text[at:])
