"""Each stage of the pipeline on its own input, and the whole run."""

import random

import corpus_pipeline as p
from lumenrec.llm import line_dedup, near_dup, quality, secret_scan
from tests.llm.helpers import docs, edge_rows, prose, records


def rows():
    rnd = random.Random(11)
    base = [(100 + i, prose(rnd, rnd.randint(30, 200), 2000)) for i in range(60)]
    shared = "a line which every one of these documents holds, word for word"
    base += [(200 + i, f"{prose(rnd, 60, 2000)}\n{shared}") for i in range(8)]
    base += [(300, base[0][1]), (301, base[1][1] + " end"), (302, "password=3aef074f60e834b34e " + prose(rnd, 50)), (303, "spam " * 100)]
    return base + edge_rows()


def test_stage_names_and_order():
    assert [f.__name__ for _, f in p.STAGES] == ["quality_rules", "dedup_lines", "near_duplicates", "redact_secrets", "pack_sequences"]
    assert p.ORACLE_SQL is None


def test_stages_and_run(spark, tmp_path):
    source = docs(spark, rows(), clash=False)
    source.write.parquet(str(tmp_path / "documents.parquet"))
    d = spark.read.parquet(str(tmp_path / "documents.parquet"))
    want = [
        lambda x: records(quality.quality_rules(x).filter("kept"), "doc_id"),
        lambda x: records(line_dedup.drop_common_lines(x), "doc_id"),
        lambda x: records(near_dup.near_duplicates(x).filter("kept"), "doc_id"),
        lambda x: records(x, "doc_id"),
    ]
    for (name, stage), ids in zip(p.STAGES[:-1], want):
        out = stage(spark, d, str(tmp_path))
        assert out.columns == source.columns and out.dtypes == source.dtypes, name
        out.write.parquet(str(tmp_path / name))
        expected, d = ids(d), spark.read.parquet(str(tmp_path / name))
        assert records(d, "doc_id") == expected, name
    kept = {r.doc_id: r.text for r in d.collect()}
    assert 303 not in kept and 300 not in kept and 301 not in kept and 100 in kept       # junk, copies
    assert sum("every one of these" in t for t in kept.values()) == 1                    # the shared line
    assert kept[302].startswith("[SECRET] ") and not any(secret_scan.find_spans(t, 40.0) for t in kept.values())
    packed = p.STAGES[-1][1](spark, d, str(tmp_path))
    assert {r.doc_id for r in packed.collect()} == set(kept)
    whole = p.run(spark, str(tmp_path))
    assert records(whole, "doc_id", "piece", "length", "ids_crc32") == records(packed, "doc_id", "piece", "length", "ids_crc32")


def test_near_duplicate_stage_links_from_080(spark):
    rnd = random.Random(17)
    pairs, kept = [], set()
    for i in range(12):
        words = [f"w{rnd.randrange(10**9)}" for _ in range(204)]                # 200 shingles
        changed = (18, 20, 22, 26)[i % 4]                                       # similarity 0.835, 0.818, 0.802, 0.770
        near = words[:-changed] + [f"v{rnd.randrange(10**9)}" for _ in range(changed)]
        pairs += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(near))]
        kept |= {2 * i} | ({2 * i + 1} if changed == 26 else set())
    out = p.near_duplicates(spark, docs(spark, pairs, clash=False), "")
    assert {r.doc_id for r in out.collect()} == kept
