from pyspark.sql import functions as F

from corpusloom.llm import ledger as L

ROWS = [
    (1, "A b-C", "https://h/x%2Dy?a=1&b=2"), (2, " a B c!", "HTTPS://H//x-y/?b=2&A=1"), (3, "A b C", "https://h/x-y?a=1"), (4, None, None), (5, "", ""), (6, "ü 1", "https://h/%C3%BC?x=%41%"), (7, "Ü1", "https://h/ü?x=a%"), (8, "A b C d", "https://h/x-y?a=1&b=2"),
]


def frame(spark, rows):
    return spark.createDataFrame([(*r, 0, "x") for r in rows], "id int, title string, url string, copies int, key string")


def test_groups(spark):
    k = L.keyed(frame(spark, ROWS + ROWS[2:3]))
    book = L.batch_counts(k)
    got = sorted((r.group_id, r.id) for r in L.copies(k, book).collect())
    assert got == [(1, 1), (1, 2), (3, 3), (3, 3), (4, 4), (4, 5), (6, 6), (6, 7)]
    assert L.copies(k.limit(0), L.batch_counts(k.limit(0))).isEmpty()


def test_incremental(spark, tmp_path):
    k = L.keyed(frame(spark, [(i, f"t{i % 7}", "u" * 30000 if i % 2 else "v") for i in range(60)]))
    whole = {(bytes(r.key), r.copies, r.first_id) for r in L.batch_counts(k).collect()}
    parts = [k.where(F.col("id") % 3 == i) for i in (2, 0, 1)]
    merged = L.merge_ledger(L.merge_ledger(L.batch_counts(parts[0]), parts[1]), parts[2])
    assert {(bytes(r.key), r.copies, r.first_id) for r in merged.collect()} == whole
    path = str(tmp_path / "ledger")
    for p in parts:
        L.apply_batch(path, p)
    assert {(bytes(r.key), r.copies, r.first_id) for r in spark.read.parquet(path).collect()} == whole
