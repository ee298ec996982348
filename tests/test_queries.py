import numpy as np
import pytest

from hostweave.operators import neighbors
from hostweave.plans import catalog
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_equals_its_sql(spark, duck, name):
    assert compare(spark, catalog.QUERIES[name], catalog.ORACLES[name], SF, duck) == ""


def test_entry_points(spark):
    import __spark_entry__ as entry

    assert set(catalog.ORACLES) <= set(entry.oracle_sql()) and set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() == 12


def test_exported_shards(spark):
    assert catalog.export_shards(spark, SF).where('intact').count() == 6


def test_every_edge_has_its_negatives(spark):
    n, edges = catalog.derived.num_nodes(spark, SF), catalog.derived.edges(spark, SF).count()
    got = [tuple(r) for r in catalog.QUERIES["uniform_negatives_all"](spark, SF).select("eid", "k", "neg_id").collect()]
    assert edges > 500 and len(got) == 5 * edges
    assert set(got) == {(e, k, (e * 5 + k + 42) * 11400714819323198485 % 2**64 % n) for e in range(edges) for k in range(5)}


def test_norms_of_all_leading_rows(spark):
    rows = catalog.derived.vectors(spark, SF).where("id < 4096").collect()
    norms = [sum(float(x) ** 2 for x in r["embedding"]) ** 0.5 for r in rows]
    got = catalog.QUERIES["input_norms_leading"](spark, SF).first()
    assert len(norms) > 300 and abs(got["norm_mean"] - sum(norms) / len(norms)) < 1e-4
    assert abs(got["norm_min"] - min(norms)) < 1e-4 and abs(got["norm_max"] - max(norms)) < 1e-4


@pytest.mark.parametrize("small", [False, True])
def test_nearest_of_every_due_query(spark, small):
    emb = catalog.derived.table(spark, SF, "embeddings").withColumnRenamed("vec_id", "id")
    unit = {}
    for r in emb.collect():
        x = np.array(r["embedding"], dtype=np.float64)
        unit[r["id"]] = (x / np.sqrt((x * x).sum())).astype(np.float32).astype(np.float64)
    want = {}
    for q in (i for i in unit if i % 50 == 0):
        near = sorted((-round(float(unit[q] @ v), 6), i) for i, v in unit.items() if i != q)[:5]
        want |= {(q, rank): i for rank, (_, i) in enumerate(near, 1)}
    out = neighbors.cosine_topk(emb, emb.where("id % 50 = 0"), 5, centres=9, block=20) if small else catalog.QUERIES["cosine_topk_all"](spark, SF)
    assert {(r["query_id"], r["rank"]): r["neighbor_id"] for r in out.collect()} == want and len(want) > 5 * 5
