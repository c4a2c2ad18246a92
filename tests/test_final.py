import random

from tessera.plans.final import by_country, run
from tessera.operators import assign as A
from tessera.sources.layout import Layout, parcel


def write(path, header, rows):
    path.write_text("\n".join("\t".join(r) for r in [header, *rows]) + "\n", encoding="utf-8")


def make(folder, split, seed, n=60):
    g = random.Random(seed)
    word = lambda: "".join(g.choices("abcdefghilmnoprstu", k=g.randint(4, 8)))
    head = ("entity_id", "business_name", "business_address", "country")
    rows, truth = {1: [], 2: [], 3: []}, []
    for i in range(1, n + 1):
        name, addr, country = f"{word()} {word()} Inc", f"{g.randint(1, 999)} {word()} Street", g.choice(["US", "FR"])
        rows[1].append((f"S1-{i}", name, addr, country))
        own = []
        for s in (2, 3):
            if g.random() < 0.8:
                rows[s].append((f"S{s}-{i}", name.replace("Inc", "Incorporated").upper(), addr.replace("Street", "St"), country))
                own.append(f"S{s}-{i}")
            rows[s].append((f"S{s}-{1000 + i}", f"{word()} {word()}", f"{g.randint(1, 999)} {word()} Road", country))
        truth.append((f"S1-{i}", ",".join(own)))
    for s in rows:
        write(folder / f"{split}_source{s}.tsv", head, rows[s])
    write(folder / f"{split}_ground_truth.tsv", ("source1_entity_id", "matched_entity_ids"), truth)


def test_run(spark, tmp_path):
    data = tmp_path / "data"
    data.mkdir()
    make(data, "train", 1)
    make(data, "test", 2, 30)
    at = Layout(str(tmp_path))
    params = {"maxDepth": 2, "maxIter": 3, "minInstancesPerNode": 1, "featureSubsetStrategy": "all"}
    got = run(spark, at, params, cap=1000)
    assert got["violations"] == [] and got["holdout"]["macro_f05"] > 0.9
    again = run(spark, at, params, cap=1000)  # every table is there already
    assert again == got
    want = dict(line.split("\t") for line in (data / "test_ground_truth.tsv").read_text().splitlines()[1:])
    lines = [x.split("\t") for x in (tmp_path / "output/matching_results.tsv").read_text().splitlines()]
    found = {x[0]: x[1] for x in lines if x[0] != "source1_entity_id"}
    assert found.keys() == want.keys() and sum(found[k] == want[k] for k in want) >= 27
    best = A.best_per_query(spark.read.parquet(at.table("train", "scores")))
    truth = spark.read.parquet(at.table("train", "truth"))
    entities = spark.read.parquet(at.table("train", "records")).where("src = 1").selectExpr("id as s1_id", "country")
    assert set(by_country(best, truth, entities)) == {"US", "FR"}


def test_parcel(tmp_path):
    (tmp_path / "a").write_text("x")
    parcel({"in/a": str(tmp_path / "a")}, str(tmp_path / "z.zip"))
    assert (tmp_path / "z.zip").stat().st_size > 0
    try:
        parcel({"b": str(tmp_path / "b")}, str(tmp_path / "y.zip"))
        raise AssertionError
    except FileNotFoundError:
        assert not (tmp_path / "y.zip").exists()
