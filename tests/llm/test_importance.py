import hashlib
import math
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from compare import spark_rows, sql_rows
from edge_cases import LONG, ROWS, documents, no_documents

from ledgerlens.llm import importance, queries
from ledgerlens.llm.common import Workspace
from ledgerlens.llm.oracle import ORACLE

SF = "/root/testdata/sf0.001"
TARGET = ["The cat sat on the mat.", "word1 word2 word3, word4", None, "", "straße 日本"]


def features(text, most_words):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    return words, [" ".join(words[i : i + n]) for n in range(1, most_words + 1) for i in range(len(words) - n + 1)]


def brute_force(rows, target, most_words, buckets, least_words, percent, seed):
    def counts(texts):
        found = [0] * buckets
        for text in texts:
            for feature in features(text, most_words)[1]:
                found[zlib.crc32(feature.encode()) % buckets] += 1
        return found

    s, t = counts(text for _, text in rows), counts(target)
    ratio = (sum(s) + buckets) / (sum(t) + buckets)
    gains = [math.floor(1000 * math.log((b + 1) / (a + 1) * ratio)) for a, b in zip(s, t, strict=True)]
    scored = []
    for i, text in rows:
        words, own = features(text, most_words)
        weight = math.floor(Fraction(sum(gains[zlib.crc32(f.encode()) % buckets] for f in own), len(own))) if own else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        noise = math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))
        scored.append((i, len(words), len(own), weight, weight + noise))
    order = sorted((r for r in scored if r[1] >= least_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2:]))
    drawn = [r[:1] + r[2:] + (n,) for n, r in enumerate(order[: percent * len(order) // 100], 1)]
    rest = order[len(drawn) :] + [r for r in scored if r[1] < least_words]
    return drawn + [r[:1] + r[2:] + (None,) for r in rest]


def target_table(spark, texts=TARGET):
    return spark.createDataFrame([(n, text, n) for n, text in enumerate(texts)], "item_id long, text string, bucket long")


@pytest.mark.parametrize(("most_words", "least_words", "percent"), [(1, 3, 50), (1, 0, 100), (3, 1, 30), (2, 20, 10)])
def test_equals_brute_force(spark, most_words, least_words, percent):
    rows = [*ROWS, *[(1000 + i, f"A-b{i}'s cat_{i % 7} SAT {i % 3}é " * (i % 9)) for i in range(200)]]
    found = importance.resample(
        documents(spark, rows).repartition(5), target_table(spark), Workspace(spark, "t"),
        most_words=most_words, buckets=997, least_words=least_words, percent=percent, seed=7,
    )
    assert found.columns == ["doc_id", "n_features", "weight", "score", "rank"] and {kind for _, kind in found.dtypes} == {"bigint"}
    want = brute_force(rows, TARGET, most_words, 997, least_words, percent, 7)
    # Rows of one id and score may swap their ranks.
    assert sorted(tuple(map(str, r)) for r in found.collect()) == sorted(tuple(map(str, r)) for r in want)


def test_spans_are_those_of_all_runs():
    text = b"  one-TWO three,,3four \xc3\xa9!"
    plain = importance.folded(text)
    assert plain == b"one two three 3four \xc3\xa9"
    ones, twos, threes = importance.scanner(3)(plain)
    assert [plain[i:j] for i, j in ones] == plain.split()
    assert [plain[i:j] for i, j in twos] == [b"one two", b"two three", b"three 3four", b"3four \xc3\xa9"]
    assert [plain[i:j] for i, j in threes] == [b"one two three", b"two three 3four", b"three 3four \xc3\xa9"]
    assert importance.scanner(2)(b"") == [[], []] and importance.scanner(2)(b"a") == [[(0, 1)], []]


def test_empty_tables(spark):
    space = Workspace(spark, "t")
    assert importance.resample(no_documents(spark), target_table(spark), space).count() == 0
    none = target_table(spark, [])
    rows = [(i, LONG[: 500 + i]) for i in range(30)]
    found = importance.resample(documents(spark, rows), none, space).collect()
    want = brute_force(rows, [], 1, importance.BUCKETS, 20, 10, importance.SEED)
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, want))
    assert sum(r.rank is not None for r in found) == 3


def test_a_third_of_all_rows_alike_is_cut_into_ranges(spark):
    same = [(None, LONG[:400])] * 1000
    rows = same + [(i, LONG[i % 50 : 300 + i]) for i in range(2000)]
    space = Workspace(spark, "t")
    docs = documents(spark, rows)
    found = importance.resample(docs, target_table(spark), space, percent=100)
    ranks = sorted(r.rank for r in found.collect())
    assert ranks == list(range(1, 3001))
    parts = spark.read.parquet(f"{space.root}/placed").groupBy("part").count().collect()
    assert len(parts) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert max(r["count"] for r in parts) < 2 * 3000 / len(parts)


def test_query_matches_sql(spark):
    assert spark_rows(queries.op11_importance(spark, SF)) == sql_rows(ORACLE["op11_importance"], SF)


def test_heavier_documents_are_drawn_more_often(spark):
    gains = np.zeros(importance.BUCKETS, dtype=np.int64)
    gains[zlib.crc32(b"cat") % importance.BUCKETS] = 3000
    rows = [(i, "cat " * 20 if i % 2 else "dog " * 20) for i in range(2000)]
    scores = importance.document_scores(documents(spark, rows), gains).orderBy("score", ascending=False).limit(200).collect()
    assert sum(r.doc_id % 2 for r in scores) > 180
