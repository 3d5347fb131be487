"""Buckets of ids stay even whatever the ids are."""

from kinweave.llm import spotsigs


def test_an_outlying_id_does_not_fill_one_bucket(spark, monkeypatch):
    ids = [*range(0, 3000, 3), -(2**62), 2**62, 2**62 + 1]
    df = spark.createDataFrame([(i, f"text {i}") for i in ids], "doc_id long, text string")
    seen = []
    plain = type(df).repartition

    def watched(self, *by):
        if by == ("bucket",):
            seen.extend(r["count"] for r in self.groupBy("bucket").count().collect())
        return plain(self, *by)

    monkeypatch.setattr(type(df), "repartition", watched)
    found = spotsigs.with_next(df, rows_per_bucket=50).collect()
    order = sorted(ids)
    assert {r.id: r.next_text for r in found} == {a: f"text {b}" for a, b in zip(order, order[1:] + order[:1])}
    assert len(found) == len(ids) and len(seen) > 10 and max(seen) <= 110
