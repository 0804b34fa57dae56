import random
from hashlib import md5

from compare import spark_rows, sql_rows
from edge_cases import ROWS, documents, no_documents
from pyspark.sql import functions as F

from ledgerlens.llm import line_chunks, oracle, queries
from ledgerlens.llm.common import Workspace


def chunks(text):
    """(start, lines) of the content-defined chunks."""
    lines = text.split("\n")
    hashes = [int(md5(line.encode()).hexdigest()[:7], 16) for line in lines]
    out, held, begin = [], [], 0
    for i, line in enumerate(lines):
        held.append(line)
        if (hashes[i] + 31 * (hashes[i - 1] if i else 0)) % 2 == 0 or i == len(lines) - 1:
            out.append((begin, held))
            held, begin = [], i + 1
    return out


def cleaned(rows):
    """Text, lines and chunks removed for each row, by scanning documents in order."""
    order = sorted({(i, t or "") for i, t in rows}, key=lambda r: (r[0] is None, r[0] or 0, md5(r[1].encode()).hexdigest()))
    seen, result = set(), {}
    for i, text in order:
        kept, lines, gone = [], 0, 0
        for _, own in chunks(text):
            if len(own) > 1 and tuple(own) in seen:
                lines, gone = lines + len(own), gone + 1
                continue
            seen.add(tuple(own))
            kept += own
        result[i, text] = ("\n".join(kept), len(text.split("\n")), lines, gone)
    return sorted(((i, *result[i, t or ""]) for i, t in rows), key=str)


def check(spark, rows, partitions=3):
    found = line_chunks.dedup_lines(documents(spark, rows).repartition(partitions), Workspace(spark, "t")).collect()
    assert sorted(map(tuple, found), key=str) == cleaned(rows)
    return found


def test_edge_cases(spark):
    rows = [*ROWS, (20, "\n"), (21, "a\n\n\nb\n"), (22, "\n".join(["same line"] * 500)), (23, "\n".join(["same line"] * 500))]
    check(spark, rows)
    assert line_chunks.dedup_lines(no_documents(spark), Workspace(spark, "t")).count() == 0


def test_shared_passages_go_wherever_they_stand(spark):
    rng = random.Random(1)
    line = lambda: " ".join(f"w{rng.randrange(10_000)}" for _ in range(8))
    passage = [line() for _ in range(12)]
    rows = []
    for i in range(200):
        own = [line() for _ in range(rng.randrange(6))]
        at = rng.randrange(len(own) + 1)
        rows.append((i, "\n".join([*own[:at], *passage, *own[at:]] if i % 3 else own)))
    found = {r.doc_id: r for r in check(spark, rows, 8)}
    sharing = [i for i, _ in rows if i % 3]
    inside = [n for n, (_, own) in enumerate(chunks("\n".join(passage))) if len(own) > 1]
    assert inside and found[sharing[0]].removed_lines == 0
    assert all(found[i].removed_lines >= 3 for i in sharing[1:])
    assert all(found[i].removed_lines == 0 for i, _ in rows if i % 3 == 0)


def test_different_texts_with_one_key_stay_apart(spark, monkeypatch):
    """All chunks get one key, so only their bytes tell them apart."""
    rows = [(i, "\n".join(f"line {n} of {i % 4}" for n in range(9))) for i in range(12)]
    keyed = line_chunks.chunk_rows
    monkeypatch.setattr(line_chunks, "chunk_rows", lambda docs: keyed(docs).withColumn("key", F.lit(0).cast("long")))
    found = check(spark, rows)
    assert {r.doc_id for r in found if r.removed_chunks} <= set(range(4, 12))
    assert sum(r.removed_chunks for r in found) > 8


def test_query_matches_sql(spark):
    got = spark_rows(queries.op8_line_chunks(spark, "/root/testdata/sf0.001"))
    assert got == sql_rows(oracle.ORACLE["op8_line_chunks"], "/root/testdata/sf0.001")


def test_no_python_in_the_plan(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = line_chunks.dedup_lines(docs, Workspace(spark, "t"))._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def without_passages(rows):
    """Text, lines and passages removed for each row, by scanning documents in order."""
    order = sorted({(i, t or "") for i, t in rows}, key=lambda r: (r[0] is None, r[0] or 0, md5(r[1].encode()).hexdigest()))
    first, result = {}, {}
    for i, text in order:
        lines = text.split("\n")
        own = [n for n, line in enumerate(lines) if line.strip(" \t\n\v\f\r")]
        spans = [(n, n) for n in own if len(lines[n].encode()) >= line_chunks.LONG_LINE] + list(zip(own, own[1:]))  # noqa: B905, RUF005
        gone = set()
        for low, high in sorted(spans):
            place = (i, text, low)
            if first.setdefault(tuple(lines[low : high + 1]), place) != place:
                gone |= set(range(low, high + 1))
        kept = "\n".join(line for n, line in enumerate(lines) if n not in gone)
        result[i, text] = (kept, len(lines), len(gone), sum(n - 1 not in gone for n in gone))
    return sorted(((i, *result[i, t or ""]) for i, t in rows), key=str)


def test_passages_on_edge_cases(spark):
    rows = [*ROWS, (20, "\n"), (21, "a\n\n\nb\n"), (22, "\n".join(["same line"] * 500)), (23, "\n".join(["same line"] * 500)), (24, "c\na\n\n\nb\n\n")]
    found = line_chunks.dedup_passages(documents(spark, rows).repartition(3), Workspace(spark, "t")).collect()
    assert sorted(map(tuple, found), key=str) == without_passages(rows)
    assert line_chunks.dedup_passages(no_documents(spark), Workspace(spark, "t")).count() == 0


def test_passages_match_a_scan_of_the_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    found = line_chunks.dedup_passages(docs.repartition(5), Workspace(spark, "t")).collect()
    assert sorted(map(tuple, found), key=str) == without_passages(rows)


def shares(rows, found, passages):
    """Share of the words of repeated passages that went, by lines a passage."""
    words = {length: [0, 0] for length in passages}
    for i, length in rows:
        left = set(found[i].split("\n"))
        for line in passages[length]:
            words[length][0] += len(line.split()) * (line not in left)
            words[length][1] += len(line.split())
    return {length: round(gone / every, 2) for length, (gone, every) in words.items()}


def test_planted_passages_go_whole(spark):
    """Passages of 56 words or more in 1 to 16 lines, each in 40 documents between lines of their own."""
    rng = random.Random(2)
    words = lambda n: " ".join(f"w{rng.randrange(10_000)}" for _ in range(n))
    rows, planted, passages = [], [], {}
    for length in (1, 2, 3, 4, 8, 16):
        passages[length] = [words(max(7, -(-56 // length))) for _ in range(length)]
        for copy in range(40):
            before, after = ([words(8) for _ in range(rng.randrange(4))] for _ in range(2))
            rows.append((len(rows), "\n".join([*before, *passages[length], *after])))
            if copy:
                planted.append((len(rows) - 1, length))
    docs = documents(spark, rows).repartition(5)
    found = line_chunks.dedup_passages(docs, Workspace(spark, "t")).collect()
    assert shares(planted, {r.doc_id: r.text for r in found}, passages) == dict.fromkeys(passages, 1.0)
    assert sum(r.removed_lines for r in found) == 39 * sum(passages)
    chunked = {r.doc_id: r.text for r in line_chunks.dedup_lines(docs, Workspace(spark, "t")).collect()}
    print("chunks alone:", shares(planted, chunked, passages))


def test_no_python_in_the_plan_of_passages(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = line_chunks.dedup_passages(docs, Workspace(spark, "t"))._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
