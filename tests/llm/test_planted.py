"""The registered queries without SQL, and the pipeline, on a folder of planted cases: against plain
Python."""

import random
import zlib
from array import array
from collections import Counter

import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from rainfold.llm import line_dedup, queries
from rainfold.llm.near_dedup import Rule
from tests.llm import test_line_dedup, test_near_dedup
from tests.llm.conftest import prose
from tests.llm.test_near_dedup import edited
from tests.llm.test_pii import plain_spans

ITEMS = [(1, "Which of the seven rivers crosses the old town before noon? The river Alba does so."),
         (2, prose(7001, 30) + ". " + prose(7002, 8)), (3, None)]
LINE = "\nThis is a line of boilerplate that many documents share.\n"
RUDE = ("grobbel", "vexnit", "drulk")


def toxic(seed):
    rng, words = random.Random(seed), prose(seed, 70).split()
    for _ in range(6):
        words.insert(rng.randrange(len(words)), rng.choice(RUDE))
    return " ".join(words)


def junk(seed):
    rng = random.Random(seed)
    return " ".join(rng.choice(["###", "$$$ $$", "%&%", "aaa", "0 0 0"]) for _ in range(60))


def rows():
    out = [(i, prose(i, 70)) for i in range(120)]
    out += [(200 + i, toxic(200 + i)) for i in range(40)]
    out += [(300 + i, junk(300 + i)) for i in range(40)]
    out += [(400 + i, edited(prose(900, 120), i, min(i, 1))) for i in range(6)]
    out += [(410 + i, prose(910, 80)) for i in range(4)]
    out += [(420 + i, prose(920 + i, 60) + LINE + prose(940 + i, 20)) for i in range(7)]
    out += [(430, f"{prose(950, 90)} {ITEMS[0][1]} {prose(951, 40)}"), (431, ITEMS[1][1].upper())]
    out += [(440, None), (441, ""), (442, "write to ann.b@mail.example.com or +1 (499) 555-6503"),
            (443, prose(960, 5_000))]
    return out


@pytest.fixture(scope="module")
def sf_dir(tmp_path_factory):
    folder, docs = tmp_path_factory.mktemp("planted"), rows()
    ids, texts = zip(*docs)

    def write(name, **columns):
        pq.write_table(pa.table(columns), f"{folder}/{name}.parquet")

    write("documents", doc_id=pa.array(ids, pa.int64()), text=pa.array(texts, pa.string()),
          lang=["en"] * len(ids), source=["s"] * len(ids),
          n_chars=pa.array([len(t or "") for t in texts], pa.int64()))
    labelled = [i for i in ids if i < 400]
    write("labels", doc_id=pa.array(labelled, pa.int64()),
          quality=pa.array([int(i < 300) for i in labelled], pa.int32()),
          toxic=pa.array([int(200 <= i < 300) for i in labelled], pa.int32()))
    write("benchmark", item_id=pa.array([i for i, _ in ITEMS], pa.int64()),
          text=pa.array([t for _, t in ITEMS], pa.string()))
    return str(folder)


def held_out(doc_id, parts, rest):
    return zlib.crc32(str(doc_id).encode()) % parts == rest


def test_contaminated_documents(spark, sf_dir):
    found = {(r.doc_id, r.item_id) for r in queries.op1_decontamination(spark, sf_dir).collect()}
    assert found == {(430, 1), (431, 2)}


def test_quality(spark, sf_dir):
    found = queries.op3_quality(spark, sf_dir).collect()
    assert [r.held_out for r in found] == [held_out(r.doc_id, 5, 0) for r in found]
    assert sorted(r.doc_id for r in found) == sorted(i for i, _ in rows())
    wrong = [r for r in found if r.doc_id < 400 and r.predicted != int(r.doc_id < 300)]
    assert len(wrong) <= 4 and all(0 <= r.score <= 1 for r in found)


def test_toxicity(spark, sf_dir):
    found = queries.op6_toxicity(spark, sf_dir).collect()
    assert [r.held_out for r in found] == [held_out(r.doc_id, 3, 1) for r in found]
    assert {r.doc_id for r in found if r.predicted} == set(range(200, 240))


def test_near_duplicates(spark, sf_dir):
    found = sorted(tuple(r) for r in queries.op8_near_dedup(spark, sf_dir).collect())
    assert found == test_near_dedup.brute_force(rows(), Rule(4, 80))


def pieces_of(docs):
    exact = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    wanted = Counter()
    for i, text in docs:
        ids = exact.encode(text or "", add_special_tokens=False).ids + [1]
        for start in range(0, len(ids), 2048):
            piece = ids[start : start + 2048]
            wanted[i, start, len(piece), zlib.crc32(array("I", piece)), len(ids)] += 1
    return wanted


def pieces_found(found):
    return Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in found)


def test_packing(spark, sf_dir):
    found = queries.op10_packing(spark, sf_dir).collect()
    assert pieces_of(rows()) == pieces_found(found)
    ends = Counter()
    for r in sorted(found, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends[r.sequence_id]
        ends[r.sequence_id] += r.length
    assert max(ends.values()) <= 2048


def test_personal_data(spark, sf_dir):
    found = queries.op12_personal_data(spark, sf_dir).collect()
    assert len(found) == len(rows())
    for (i, text), r in zip(sorted(rows()), sorted(found, key=lambda r: r.doc_id)):
        base = plain_spans(text or "")
        counts = Counter(kind for kind, _, _ in base)
        assert (r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone) == (
            i, *(counts[k] for k in ("email", "ip", "card", "phone")),
        )
        assert {f"{k}:{a}:{b}" for k, a, b in base} <= set(r.spans.split(","))


def test_pipeline(spark, sf_dir):
    docs = [(i, t) for i, t in rows() if not 200 <= i < 300]
    decided = test_line_dedup.brute_force(docs, line_dedup.Rule())
    docs = [(i, kept) for i, _, _, kept in decided]
    classes = test_near_dedup.brute_force(docs, Rule())
    gone = {i for i, _, _, kept in classes if not kept} | {430, 431}
    packed = corpus_pipeline.run(spark, sf_dir).collect()
    assert {401, 411} <= gone
    wanted = pieces_of([(i, t) for i, t in docs if i not in gone])
    assert pieces_found(packed) == wanted
