from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
from texts import awkward, frame, prose

from tidemark.llm import lexical_packing
from tidemark.llm.queries import QUERIES
from tidemark.llm.word_tokenizer import WordTokenizer
from tools.check_queries import duck

SF_DIR = "/root/testdata/sf0.001"


def topical(rng, n, topics=6):
    words = {t: [prose(rng, 1).strip(".\n") + str(t) for _ in range(40)] for t in range(topics)}
    common = [prose(rng, 1) for _ in range(200)]
    out = []
    for i in range(n):
        t = i % topics
        size = rng.randint(20, 120)
        out.append((1000 + i, " ".join(rng.choice(words[t] if rng.random() < 0.4 else common) for _ in range(size)), "en", "a", 1))
    return out


def reference_ids(data):
    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(lexical_packing.public_vocabulary())
    return [[*slow.encode(t or "", add_special_tokens=False).ids, 1] for _, t, *_ in data]


def check_pieces(got, data, sequence):
    want = defaultdict(list)
    for (key, *_), ids in zip(data, reference_ids(data)):
        want[key].append(ids)
    pieces = defaultdict(list)
    places = defaultdict(list)
    for r in got:
        pieces[r["doc_id"]].append(r)
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(pieces) == set(want)
    for key, texts in want.items():
        # rows with one key are told apart by taking each piece from any of them
        left = [list(range(len(ids))) for ids in texts]
        for r in pieces[key]:
            span = range(r["start"], r["start"] + r["length"])
            for n, ids in enumerate(texts):
                crc = zlib.crc32(np.array(ids[span.start : span.stop], "<u4").tobytes())
                if len(ids) == r["doc_tokens"] and crc == r["ids_crc32"] and set(span) <= set(left[n]):
                    left[n] = [x for x in left[n] if x not in span]
                    break
            else:
                raise AssertionError(r)
        assert not any(left)
    padding = 0
    for where in places.values():
        where.sort()
        ends = np.cumsum([0, *[n for _, n in where]])
        assert [o for o, _ in where] == ends[:-1].tolist() and ends[-1] <= sequence
        padding += 0 if ends[-1] & (ends[-1] - 1) == 0 else sequence - ends[-1]
    return padding, places


def test_chunks_have_the_ids_of_whole_texts():
    rng = random.Random(2)
    texts = [t or "" for _, t, *_ in awkward()] + [prose(rng, 300)]
    texts += ["It's I'LL don't 'TWAS 12.5% (a_b) ÉTÉ İstanbul ΣΑΣ straße x é ﬁ <|endoftext|>x \u0085 a\x1cb 漢字 ก็ 😀😀 ", "A" * 3000, "x." * 700]
    texts += ["".join(rng.choice("abcéñ'’.,;-_ 0123\n\tXYŹßẞİ") for _ in range(400)) for _ in range(60)]
    words = WordTokenizer(lexical_packing.public_vocabulary())
    for text, ids in zip(texts, reference_ids([(0, t) for t in texts])):
        assert words.encode(text.encode()).tolist() == ids[:-1]


def test_every_id_lies_in_one_piece_and_nothing_is_padded(spark):
    rng = random.Random(13)
    data = awkward() + topical(rng, 150)
    data += [(5000 + i, "the same words again and again", "en", "a", 1) for i in range(300)]
    for sizes in ({}, {"sequence": 256, "shard_tokens": 3000}):
        got = lexical_packing.pack_documents(frame(spark, data, clash=True), **sizes).collect()
        padding, _ = check_pieces(got, data, sizes.get("sequence", 2048))
        assert padding == 0


def test_windows_hold_documents_of_one_topic(spark):
    data = topical(random.Random(3), 240)
    topic = {d: i % 6 for i, (d, *_) in enumerate(data)}
    got = lexical_packing.pack_documents(frame(spark, data), sequence=1024).collect()
    windows = defaultdict(list)
    for r in got:
        windows[r["sequence_id"]].append(topic[r["doc_id"]])
    pairs = [(a, b) for w in windows.values() for i, a in enumerate(w) for b in w[:i]]
    assert len(pairs) > 300 and sum(a == b for a, b in pairs) > 0.7 * len(pairs)


def test_scores_are_those_of_the_formula():
    rng = np.random.default_rng(0)
    items = [rng.integers(0, 30, n) for n in (12, 0, 40, 7, 7)]
    idf = rng.random(30)
    scores = lexical_packing.Index(items, idf, 13.2).scores(np.unique(items[0]))
    for item, score in zip(items, scores):
        tf = [(t, int((item == t).sum())) for t in np.unique(items[0])]
        want = sum(idf[t] * f * 2.2 / (f + 1.2 * (0.25 + 0.75 * len(item) / 13.2)) for t, f in tf)
        assert abs(score - want) < 1e-9


def test_ids_can_be_kept(spark):
    data = topical(random.Random(4), 12) + [(1, "word " * 700, "en", "a", 1)]
    got = lexical_packing.pack_documents(frame(spark, data), sequence=256, with_ids=True).collect()
    whole = defaultdict(dict)
    for r in got:
        whole[r["doc_id"]][r["start"]] = np.frombuffer(r["ids"], "<u2").tolist()
    for (key, *_), ids in zip(data, reference_ids(data)):
        assert sum((p for _, p in sorted(whole[key].items())), []) == ids


def test_query_on_all_documents(spark):
    got = QUERIES["op13_lexical_packing"](spark, SF_DIR).collect()
    data = duck(SF_DIR).sql("select doc_id, text from documents").fetchall()
    padding, places = check_pieces(got, data, 2048)
    assert padding == 0 and len(places) > 10


def test_packing_of_an_empty_table(spark):
    assert lexical_packing.pack_documents(frame(spark, [])).count() == 0
