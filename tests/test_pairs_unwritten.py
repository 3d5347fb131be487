"""People are compared where they meet: pairs that a veto forbids are never written."""

from kinweave.operators import interpret, reconstruct

SCHEMA = "id long, act long, row int, register string, type string, year int, role string, name string, house string, surname string, age int, sex string, trade string, place string, status string"


def test_a_crowded_block_of_newborns(spark, monkeypatch):
    n = 40
    rows = spark.createDataFrame([(i * 100, i, 1, "r", "birth", 1820 + i, "newborn", "rosa", "lela", "lela", None, "F", None, "via Nuova", None) for i in range(n)], SCHEMA)
    written, write = {}, reconstruct.materialise

    def counted(df, name):
        out = write(df, name)
        written[name] = max(written.get(name, 0), out.count())
        return out

    monkeypatch.setattr(reconstruct, "materialise", counted)
    state = reconstruct.people(rows, interpret.act_families(rows), rounds=1)
    assert state.held.where("mention = entity and step = ''").count() == n  # every one is a person of her own
    assert max(written.values()) == n, written
