"""SQL for the registered queries, over the same tables."""

from __future__ import annotations

_EDGES = "edges AS (SELECT row_number() OVER (ORDER BY l_orderkey, l_partkey, l_linenumber) - 1 AS eid, o_custkey AS src, l_partkey AS dst FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"
_N = "(SELECT count(*) FROM customer) + (SELECT count(*) FROM part)"
_NODES = f"nodes AS (SELECT unnest(range(0, {_N})) AS id)"
_DEG = f"""{_EDGES}, {_NODES}, deg AS (SELECT id, coalesce(i, 0)::BIGINT AS in_degree, coalesce(o, 0)::BIGINT AS out_degree, (coalesce(i, 0) + coalesce(o, 0))::BIGINT AS degree
 FROM nodes LEFT JOIN (SELECT dst, count(*) AS i FROM edges GROUP BY 1) a ON id = a.dst LEFT JOIN (SELECT src, count(*) AS o FROM edges GROUP BY 1) b ON id = b.src)"""
_KEEP = f"{_DEG}, keep AS (SELECT id AS orig_id, row_number() OVER (ORDER BY id) - 1 AS compact_id FROM deg WHERE degree >= 64)"
_LADDER = "t AS (SELECT unnest([1, 2, 3, 4, 8, 16, 32, 64, 128, 256, 512, 1024]) AS t)"
_LOW = "low AS (SELECT least(a.degree, b.degree) AS low FROM edges JOIN deg a ON src = a.id JOIN deg b ON dst = b.id)"


def _hash(x: str, seed: int = 42) -> str:
    return f"((({x})::HUGEINT + {seed}) * 11400714819323198485::HUGEINT % 18446744073709551616::HUGEINT)"


_SPLIT = f"{_EDGES}, parts AS (SELECT *, ({_hash('eid')} % 10)::INTEGER AS bucket, CASE {_hash('eid')} % 10 WHEN 0 THEN 'test' WHEN 1 THEN 'val' ELSE 'train' END AS split FROM edges)"
_TRAIN = f"{_SPLIT}, train AS (SELECT *, row_number() OVER (ORDER BY eid) - 1 AS o, count(*) OVER () AS n FROM parts WHERE split = 'train')"
_FRAC = "least(1.0::DOUBLE, 1.5::DOUBLE * 1000 / greatest(1, (SELECT count(*) FROM edges) // 10))"
_ORDER = f"({_hash('eid')} % {1 << 39})"
_UND = f"{_EDGES}, und AS (SELECT src, dst FROM edges UNION SELECT dst, src FROM edges)"
_HOSTS = "hosts AS (SELECT page_id, lower(regexp_extract(url, '^https?://([^/?#]*)', 1)) AS host_key FROM pages)"
_REC = f"""{_DEG}, rec AS (SELECT 'h' || id || '.site' || (id % 97) || '.com' AS host_key, 'site' || (id % 97) || '.com' AS domain_key, id AS local_node_id, in_degree, out_degree, (out_degree = 0)::INTEGER AS is_dangling,
 CASE WHEN in_degree > 0 AND out_degree > 0 THEN 'bidirectional' WHEN in_degree > 0 THEN 'in_only' WHEN out_degree > 0 THEN 'out_only' ELSE 'isolated' END AS cohort,
 CASE WHEN in_degree > 0 AND out_degree > 0 THEN 'high' WHEN in_degree > 0 OR out_degree > 0 THEN 'medium' ELSE 'low' END AS confidence FROM deg)"""
_REL = """r AS (SELECT 'c' || c_custkey || '.com' AS host_key, 1 AS seq, row_number() OVER (ORDER BY c_custkey) - 1 AS local FROM customer WHERE c_custkey % 3 <> 0
 UNION ALL SELECT 'c' || c_custkey || '.com', 2, row_number() OVER (ORDER BY c_custkey DESC) - 1 FROM customer WHERE c_custkey % 4 <> 0
 UNION ALL SELECT 'c' || c_custkey || '.com', 3, row_number() OVER (ORDER BY c_custkey) - 1 FROM customer WHERE c_custkey % 5 <> 0),
 idx AS (SELECT host_key, 'rel-' || min(seq) AS first_release, 'rel-' || max(seq) AS last_seen_release,
 CASE WHEN max(seq) < 3 THEN 'missing' WHEN bool_or(seq = 2) THEN 'active' WHEN bool_or(seq < 3) THEN 'reappeared' ELSE 'new' END AS state,
 string_agg('rel-' || seq || ':' || local, ',' ORDER BY seq) AS local_ids FROM r GROUP BY 1)"""
_SUFFIXED = """x AS (SELECT page_id, page_id % 15 AS e, page_id::VARCHAR AS p FROM pages), suffixed AS (SELECT page_id,
 CASE e WHEN 0 THEN 'www.h' || p || '.com' WHEN 1 THEN 'www.h' || p || '.co.uk' WHEN 2 THEN 'www.h' || p || '.k12.ca.us' WHEN 3 THEN 'www.h' || p || '.ck' WHEN 4 THEN 'www.h' || p || '.www.ck'
  WHEN 5 THEN 'www.h' || p || '.nsw.edu.au' WHEN 6 THEN 'www.h' || p || '.kawasaki.jp' WHEN 7 THEN 'www.h' || p || '.city.kawasaki.jp' WHEN 8 THEN 'www.h' || p || '.xn--55qx5d.cn' WHEN 9 THEN 'www.h' || p || '.nosuchdomain'
  WHEN 10 THEN '10.0.' || p || '.7' WHEN 11 THEN 'co.uk' WHEN 12 THEN 'ck' WHEN 13 THEN 'jp' ELSE 'www.ck' END AS host_key,
 CASE e WHEN 0 THEN 'h' || p || '.com' WHEN 1 THEN 'h' || p || '.co.uk' WHEN 2 THEN 'h' || p || '.k12.ca.us' WHEN 3 THEN 'www.h' || p || '.ck' WHEN 4 THEN 'www.ck'
  WHEN 5 THEN 'h' || p || '.nsw.edu.au' WHEN 6 THEN 'www.h' || p || '.kawasaki.jp' WHEN 7 THEN 'city.kawasaki.jp' WHEN 8 THEN 'h' || p || '.xn--55qx5d.cn' WHEN 9 THEN 'www.h' || p || '.nosuchdomain'
  WHEN 10 THEN '10.0.' || p || '.7' WHEN 11 THEN 'co.uk' WHEN 12 THEN 'ck' WHEN 13 THEN 'jp' ELSE 'www.ck' END AS domain_key FROM x)"""
_VEC = "vec AS (SELECT vec_id AS id, list_transform(embedding, lambda x: (x::DOUBLE * CASE WHEN vec_id % 50 = 49 THEN 0.0 ELSE 1.0 + vec_id % 7 END)::FLOAT::DOUBLE) AS v FROM embeddings)"
_UNIT = f"{_VEC}, norms AS (SELECT id, v, sqrt(list_sum(list_transform(v, lambda x: x * x))) AS n FROM vec)"
_E = "e AS (SELECT vec_id AS id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings)"
_DOT = "list_sum(list_transform(range(1, 65), lambda i: {a}[i] * {b}[i]))"
_RANKS = f"""{_E}, n AS (SELECT count(*) AS n FROM embeddings), pos AS (SELECT id AS eid, id AS src, (id * 7 + 3) % n.n AS dst FROM e, n),
 scored AS (SELECT eid, u.v AS u, round({_DOT.format(a="u.v", b="w.v")}, 6) AS pos FROM pos JOIN e u ON src = u.id JOIN e w ON dst = w.id),
 neg AS (SELECT eid, u, pos, ({_hash("eid * 100 + k")} % (SELECT n FROM n))::BIGINT AS neg_id FROM scored, (SELECT unnest(range(0, 100)) AS k)),
 ranks AS (SELECT eid, (1 + sum((round({_DOT.format(a="u", b="w.v")}, 6) > pos)::BIGINT))::BIGINT AS rank FROM neg JOIN e w ON neg_id = w.id GROUP BY 1)"""
_UNIFORM = "(('0x' || substr(md5('42:' || id || ':' || (j - 1)), {at}, 8))::BIGINT::DOUBLE + 0.5) / 4294967296"
_START = f"""{_NODES}, j AS (SELECT unnest(range(1, 9)) AS j), entries AS (SELECT id, j, (sqrt(-2 * ln({_UNIFORM.format(at=1)})) * cos(2 * pi() * ({_UNIFORM.format(at=9)})) * 0.1::DOUBLE)::FLOAT AS x FROM nodes, j),
 start AS (SELECT id, list(x::DOUBLE ORDER BY j) AS v FROM entries GROUP BY 1)"""
_DOT8 = "list_sum(list_transform(range(1, 9), lambda i: {a}[i] * {b}[i]))"
_SOFT = "greatest({x}, 0.0) + ln(1 + exp(-abs({x})))"
_LOSSES = f"""{_SPLIT}, {_START}, q AS (SELECT eid, src, dst, row_number() OVER (ORDER BY {_hash('eid', 43)} % {1 << 39}, eid) - 1 AS p, count(*) OVER () AS m FROM parts WHERE split = 'train'),
 b AS (SELECT p // 512 AS batch, eid, src, dst FROM q WHERE p // 512 < m // 512),
 u AS (SELECT batch, id, row_number() OVER (PARTITION BY batch ORDER BY id) - 1 AS l, count(*) OVER (PARTITION BY batch) AS nodes FROM (SELECT batch, src AS id FROM b UNION SELECT batch, dst FROM b)),
 w AS (SELECT b.batch, eid, s.v AS sv, {_DOT8.format(a='s.v', b='t.v')} AS pos FROM b JOIN start s ON src = s.id JOIN start t ON dst = t.id),
 z AS (SELECT batch, eid, sv, ({_hash('eid * 3 + k')} % (SELECT any_value(nodes) FROM u WHERE u.batch = w.batch))::BIGINT AS l FROM w, (SELECT unnest(range(0, 3)) AS k)),
 g AS (SELECT z.batch, {_DOT8.format(a='sv', b='v')} AS neg FROM z JOIN u ON z.batch = u.batch AND z.l = u.l JOIN start ON u.id = start.id),
 losses AS (SELECT batch, count(*) AS n, avg({_SOFT.format(x='-pos')}) + (SELECT avg({_SOFT.format(x='neg')}) FROM g WHERE g.batch = w.batch) AS loss FROM w GROUP BY batch)"""

ORACLES = {
    "degree_vector": f"WITH {_DEG} SELECT id, in_degree, out_degree, degree FROM deg",
    "degree_totals": f"WITH {_DEG} SELECT count(*) AS num_nodes, sum(out_degree)::BIGINT AS total_edges, sum((out_degree = 0)::BIGINT)::BIGINT AS n_dangling, round(sum((out_degree = 0)::BIGINT)::DOUBLE / count(*), 5) AS frac_dangling, round(sum(degree)::DOUBLE / count(*), 4) AS mean_degree FROM deg",
    "retention_ladder": f"""WITH {_DEG}, {_LADDER}, {_LOW}, k AS (SELECT t, count(*) FILTER (degree >= t) AS k, coalesce(sum(degree) FILTER (degree >= t), 0) AS e, count(*) AS n, sum(degree) AS total FROM deg, t GROUP BY t),
 i AS (SELECT t, count(*) FILTER (low >= t) AS i, count(*) AS m FROM low, t GROUP BY t)
 SELECT k.t::INTEGER AS min_degree, k AS n_nodes, round(k::DOUBLE / n, 5) AS frac_nodes, round(1 - k::DOUBLE / n, 5) AS frac_fallback, round(e::DOUBLE / greatest(total, 1), 5) AS endpoint_incidence, i AS induced_edges, round(i::DOUBLE / greatest(m, 1), 5) AS frac_edges FROM k JOIN i ON k.t = i.t""",
    "induced_edges": f"WITH {_DEG}, {_LADDER}, {_LOW} SELECT t::INTEGER AS min_degree, count(*) FILTER (low >= t) AS induced_edges FROM low, t GROUP BY t",
    "degree_histogram": f"WITH {_DEG}, b AS (SELECT unnest([0, 1, 2, 3, 5, 9, 17, 33, 65, 129, 257, 513, 1025]::BIGINT[]) AS lo, unnest([0, 1, 2, 4, 8, 16, 32, 64, 128, 256, 512, 1024, 4611686018427387903]::BIGINT[]) AS hi) SELECT lo AS deg_lo, hi AS deg_hi, count(id) AS n_nodes FROM b LEFT JOIN deg ON degree BETWEEN lo AND hi GROUP BY 1, 2",
    "min_degree_slice_edges": f"WITH {_KEEP} SELECT eid, a.compact_id AS src, b.compact_id AS dst FROM edges JOIN keep a ON src = a.orig_id JOIN keep b ON dst = b.orig_id",
    "min_degree_slice_nodes": f"WITH {_KEEP} SELECT orig_id, compact_id AS id, 'com.site' || (orig_id % 97) || '.H' || orig_id AS name FROM keep",
    "endpoint_integrity": f"WITH {_EDGES}, ids AS (SELECT src AS orig_id FROM edges UNION SELECT dst FROM edges) SELECT orig_id FROM ids WHERE orig_id NOT IN (SELECT c_custkey FROM customer)",
    "unique_endpoints": f"WITH {_EDGES} SELECT src AS id FROM edges UNION SELECT dst FROM edges",
    "to_undirected": f"WITH {_UND} SELECT row_number() OVER (ORDER BY src, dst) - 1 AS eid, src, dst FROM und",
    "undirected_degrees": f"WITH {_UND}, {_NODES} SELECT id, count(dst) AS out_degree FROM nodes LEFT JOIN und ON id = src GROUP BY 1",
    "adjacency_lists": f"WITH {_DEG}, l AS (SELECT src, string_agg(dst::VARCHAR, ',' ORDER BY eid) AS x FROM edges GROUP BY 1) SELECT id, coalesce(sum(out_degree) OVER (ORDER BY id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS \"offset\", coalesce(x, '') AS neighbors FROM deg LEFT JOIN l ON id = src",
    "adjacency_chunks": f"WITH {_EDGES}, p AS (SELECT src, dst, row_number() OVER (ORDER BY src, eid) - 1 AS place FROM edges) SELECT src AS id, place // 16 AS cell, min(place) AS \"offset\", count(*)::INTEGER AS n, string_agg(dst::VARCHAR, ',' ORDER BY place) AS neighbors FROM p GROUP BY 1, 2",
    "adjacency_offsets": f"WITH {_DEG} SELECT id, coalesce(sum(in_degree) OVER (ORDER BY id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS \"offset\", in_degree AS n FROM deg",
    "neighbors_of": f"WITH {_EDGES} SELECT 'out' AS direction, eid, dst AS neighbor FROM edges WHERE src = 7 UNION ALL SELECT 'in', eid, src FROM edges WHERE dst = 7",
    "edge_mask_subgraph": f"WITH {_EDGES} SELECT eid, src, dst FROM edges WHERE (src + dst) % 3 = 0",
    "induced_prefix": f"WITH {_EDGES}, p AS (SELECT * FROM edges WHERE eid < 1000), ids AS (SELECT id, row_number() OVER (ORDER BY id) - 1 AS c FROM (SELECT src AS id FROM p UNION SELECT dst FROM p)) SELECT eid, a.c AS src, b.c AS dst FROM p JOIN ids a ON src = a.id JOIN ids b ON dst = b.id",
    "split_assignment": f"WITH {_SPLIT} SELECT eid, bucket, split FROM parts",
    "split_counts": f"WITH {_SPLIT} SELECT split, bucket, count(*) AS n FROM parts GROUP BY 1, 2",
    "split_eval_subsample": f"WITH {_SPLIT} SELECT eid, split FROM parts WHERE (split = 'test' AND ({_hash('eid', 49)} // 1099511627776)::DOUBLE / 16777216 < {_FRAC}) OR (split = 'val' AND ({_hash('eid', 53)} // 1099511627776)::DOUBLE / 16777216 < {_FRAC})",
    "subsample_exact": f"WITH {_EDGES} SELECT eid, src, dst FROM edges ORDER BY {_ORDER}, eid LIMIT 1000",
    "permutation_split": f"WITH {_EDGES}, o AS (SELECT eid, row_number() OVER (ORDER BY {_ORDER}, eid) - 1 AS p, count(*) OVER () // 10 AS t FROM edges) SELECT eid, CASE WHEN p < t THEN 'test' WHEN p < 2 * t THEN 'val' ELSE 'train' END AS split FROM o",
    "train_stripes": f"WITH {_TRAIN} SELECT o % 4 AS rank, count(*) AS n, min(eid) AS first_eid, max(eid) AS last_eid FROM train GROUP BY 1",
    "train_slices": f"WITH {_TRAIN}, r AS (SELECT unnest(range(0, 4)) AS r) SELECT r AS rank, count(*) AS n, min(eid) AS first_eid, max(eid) AS last_eid FROM train JOIN r ON o >= n * r // 4 AND o < n * (r + 1) // 4 GROUP BY 1",
    "minibatch_local_index": f"""WITH {_EDGES}, p AS (SELECT eid, src, dst, row_number() OVER (ORDER BY {_hash('eid', 43)} % {1 << 39}, eid) - 1 AS p, count(*) OVER () AS n FROM edges),
 x AS (SELECT p // 512 AS batch, eid, src, dst, unnest([0, 1]) AS side, unnest([src, dst]) AS id FROM p WHERE p // 512 < n // 512),
 l AS (SELECT batch, eid, src, dst, side, dense_rank() OVER (PARTITION BY batch ORDER BY id) - 1 AS l FROM x)
 SELECT batch, eid, src, dst, max(l) FILTER (side = 0)::INTEGER AS local_src, max(l) FILTER (side = 1)::INTEGER AS local_dst FROM l GROUP BY 1, 2, 3, 4""",
    "uniform_negatives": f"WITH k AS (SELECT unnest(range(0, 5)) AS k), e AS (SELECT unnest(range(0, (SELECT count(*) FROM lineitem JOIN orders ON l_orderkey = o_orderkey))) AS eid) SELECT eid, k::INTEGER AS k, ({_hash('eid * 5 + k')} % ({_N}))::BIGINT AS neg_id FROM e, k",
    "host_keys": f"WITH {_HOSTS} SELECT page_id, host_key FROM hosts",
    "domain_keys": f"WITH {_HOSTS} SELECT DISTINCT host_key, array_to_string(list_slice(string_split(host_key, '.'), -2, -1), '.') AS domain_key FROM hosts",
    "domain_keys_by_rules": f"WITH {_SUFFIXED} SELECT page_id, host_key, domain_key FROM suffixed",
    "domain_key_sql": f"WITH {_SUFFIXED} SELECT domain_key, count(*) AS n, min(page_id) AS first_id FROM suffixed GROUP BY 1",
    "suffix_records": f"""WITH {_REC}, s AS (SELECT *, CASE local_node_id % 5 WHEN 0 THEN 'co.uk' WHEN 1 THEN 'k12.ca.us' WHEN 2 THEN 'ck' WHEN 3 THEN 'city.kawasaki.jp' ELSE 'com' END AS e, 'shop' || (local_node_id % 97) AS shop FROM rec)
 SELECT 'h' || local_node_id || '.' || shop || '.' || e AS host_key, CASE e WHEN 'ck' THEN 'h' || local_node_id || '.' || shop || '.ck' WHEN 'city.kawasaki.jp' THEN e ELSE shop || '.' || e END AS domain_key, local_node_id, cohort FROM s""",
    "host_records": f"WITH {_REC} SELECT * FROM rec",
    "cohort_counts": f"WITH {_REC} SELECT cohort, confidence, is_dangling, count(*) AS n FROM rec GROUP BY 1, 2, 3",
    "duplicate_keys": f"WITH {_HOSTS} SELECT host_key, count(*) AS n, min(page_id) AS first_id, max(page_id) AS last_id FROM hosts GROUP BY 1 HAVING count(*) > 1",
    "cross_release_index": f"WITH {_REL} SELECT host_key, first_release, last_seen_release, state, local_ids FROM idx",
    "streamed_release_index": f"WITH {_REL} SELECT host_key, first_release, last_seen_release, state, local_ids FROM idx",
    "streamed_degrees": f"WITH {_DEG} SELECT id, in_degree, out_degree, degree FROM deg WHERE degree > 0",
    "state_counts": f"WITH {_REL} SELECT state, count(*) AS n FROM idx GROUP BY 1",
    "keys_reappeared": f"WITH {_REL} SELECT host_key FROM idx WHERE state = 'reappeared'",
    "normalize_vectors": f"WITH {_UNIT}, u AS (SELECT id, CASE WHEN n > 0 THEN list_transform(v, lambda x: (x / n)::FLOAT::DOUBLE) ELSE v END AS v FROM norms) SELECT id, round(sqrt(list_sum(list_transform(v, lambda x: x * x))), 4) AS norm, round(v[1], 4) AS x1, round(v[64], 4) AS x64 FROM u",
    "input_norms": f"WITH {_UNIT} SELECT round(min(n), 4) AS norm_min, round(avg(n), 4) AS norm_mean, round(max(n), 4) AS norm_max FROM norms WHERE id < 4096",
    "cosine_topk": f"WITH {_E}, u AS (SELECT id, list_transform(v, lambda x: (x / sqrt(list_sum(list_transform(v, lambda y: y * y))))::FLOAT::DOUBLE) AS v FROM e), p AS (SELECT q.id AS query_id, d.id AS neighbor_id, round({_DOT.format(a='q.v', b='d.v')}, 6) AS c FROM u q, u d WHERE q.id % 50 = 0 AND q.id <> d.id), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY c DESC, neighbor_id) AS rank FROM p) SELECT query_id, rank::INTEGER AS rank, neighbor_id, round(c, 4) AS cosine FROM r WHERE rank <= 5",
    "eval_ranks": f"WITH {_RANKS} SELECT eid, rank FROM ranks",
    "eval_mrr": f"WITH {_RANKS} SELECT round(avg(1.0::DOUBLE / rank), 6) AS mrr, round(avg((rank <= 1)::INTEGER), 6) AS hits_1, round(avg((rank <= 10)::INTEGER), 6) AS hits_10 FROM ranks",
    "shard_ranges": "SELECT vec_id // 200 AS shard, min(vec_id) AS row_start, max(vec_id) + 1 AS row_end, count(*) AS n_rows FROM embeddings GROUP BY 1",
    "export_shards": f"""WITH {_UNIT}, s AS (SELECT id // 200 AS shard, min(id) AS row_start, max(id) + 1 AS row_end, count(*) AS n_rows, min('h' || id || '.com') AS least_host, count(DISTINCT id) AS domains, round(sum((n > 0)::INTEGER::DOUBLE), 3) AS norms FROM norms GROUP BY 1), t AS (SELECT unnest(['vectors', 'vectors_fp16']) AS kind), m AS (SELECT max(shard) + 1 AS shards FROM s)
 SELECT kind, shard, kind || '/emb-' || lpad(shard::VARCHAR, 5, '0') || '-of-' || lpad(shards::VARCHAR, 5, '0') || '.parquet' AS filename, row_start, row_end, n_rows, true AS intact, least_host, domains, norms FROM s, t, m""",
    "shard_edges": f"WITH {_EDGES} SELECT eid, src, dst FROM edges",
    "shard_edges_lenient": f"WITH {_EDGES} SELECT eid, src, dst FROM edges WHERE eid < 1000",
    "shard_slice_names": f"WITH {_KEEP} SELECT orig_id, compact_id AS id, 'com.site' || (orig_id % 97) || '.H' || orig_id AS name FROM keep",
    "graph_round_trip": f"WITH {_EDGES} SELECT eid, src, dst FROM edges",
    "stored_degrees": f"WITH {_DEG} SELECT id, in_degree, out_degree, degree FROM deg",
    "worker_slice": f"WITH {_TRAIN} SELECT eid, o AS train_ordinal FROM train WHERE o >= n * 2 // 4 AND o < n * 3 // 4",
    "split_round_trip": f"WITH {_SPLIT}, k AS (SELECT eid, split FROM parts WHERE split = 'train' OR (split = 'test' AND ({_hash('eid', 49)} // 1099511627776)::DOUBLE / 16777216 < {_FRAC}) OR (split = 'val' AND ({_hash('eid', 53)} // 1099511627776)::DOUBLE / 16777216 < {_FRAC})) SELECT eid, split, CASE WHEN split = 'train' THEN row_number() OVER (PARTITION BY split ORDER BY eid) - 1 END AS train_ordinal FROM k",
    "size_table": f"WITH n AS (SELECT {_N} AS n), d AS (SELECT unnest([64, 128, 256]) AS dim), p AS (SELECT unnest(['fp32', 'fp16', 'int8']) AS precision, unnest([4, 2, 1]) AS b, unnest([0.95, 0.95, 0.7]::DOUBLE[]) AS c), s AS (SELECT n::BIGINT AS n, dim, precision, n::BIGINT * dim * b AS v, n::BIGINT * 48 AS m, c FROM n, d, p) SELECT n AS num_nodes, dim::INTEGER AS dim, precision, v AS vector_bytes, m AS metadata_bytes, v + m AS total_uncompressed, round(v * c + m * 0.45::DOUBLE)::BIGINT AS total_compressed FROM s",
    "schema_fields": f"SELECT location, n, bytes, (bytes * ({_N}))::BIGINT AS all_nodes FROM (VALUES ('header', 3::BIGINT, 0::BIGINT), ('row_default', 11, 24), ('row_sidecar', 4, 8)) x(location, n, bytes)",
    "lr_schedule": f"WITH {_SPLIT} SELECT e::INTEGER AS epoch, round(0.0001 + (0.01 - 0.0001)::DOUBLE * (1 + cos(pi() * (e - 1) / 10)) / 2, 9) AS lr, (e * ceil((SELECT count(*) FROM parts WHERE split = 'train') / 512))::BIGINT AS steps FROM (SELECT unnest(range(1, 11)) AS e)",
    "batch_losses": f"WITH {_LOSSES} SELECT batch, n, round(loss, 6) AS loss FROM losses",
    "epoch_loss": f"WITH {_LOSSES} SELECT round(sum(loss * n) / greatest(sum(n), 1), 6) AS loss FROM losses",
    "initial_vectors": f"WITH {_EDGES}, {_START} SELECT id, (j - 1)::INTEGER AS place, round(x::DOUBLE, 5) AS x FROM entries",
    "train_embeddings": f"SELECT {_N} AS n_nodes, 16 AS dim, true AS loss_fell",
    "split_bucket_sql": f"WITH {_SPLIT} SELECT bucket, count(*) AS n FROM parts GROUP BY 1",
    "hash_top_bits": f"SELECT eid, ({_hash('eid')} // 1099511627776)::BIGINT AS top24, ({_hash('eid')} % 10)::INTEGER AS bucket FROM (SELECT 13070000000 + unnest(range(0, (SELECT count(*) FROM lineitem JOIN orders ON l_orderkey = o_orderkey))) AS eid)",
}
ORACLES |= {"uniform_negatives_all": ORACLES["uniform_negatives"], "input_norms_leading": ORACLES["input_norms"], "cosine_topk_all": ORACLES["cosine_topk"]}
