"""DuckDB SQL for every registered query with an SQL form (the correctness gate).

Each statement reads the raw test tables (pre-registered views) and restates the
query with plain window functions and aggregates - the single-node textbook form
the Spark operators must agree with. Statements are assembled from the named
common table expressions below; each query pulls in only what it references.
"""

from __future__ import annotations

import re

D = 9  # decimals of reported doubles (same as the Spark queries)

# name -> body; order matters only for readability, dependencies are resolved.
CTES: dict[str, str] = {
    "interactions": """
        SELECT o.o_custkey AS user_id,
               's' || CAST(l.l_partkey AS VARCHAR) AS recording_msid,
               o.o_orderdate AS "timestamp"
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""",
    "tracks": """
        SELECT 's' || CAST(p_partkey AS VARCHAR) AS recording_msid,
               CASE WHEN p_partkey % 5 = 0 THEN NULL
                    ELSE 'b' || CAST(p_partkey % 1000 AS VARCHAR) END AS recording_mbid
        FROM part""",
    "user_dim": "SELECT c_custkey AS user_id FROM customer",
    "clean": """
        SELECT i.user_id, i.recording_msid AS interactions_msid, i."timestamp",
               COALESCE(t.recording_mbid, t.recording_msid) AS recording_mbid
        FROM interactions i
        JOIN tracks t ON i.recording_msid = t.recording_msid
        JOIN user_dim u ON i.user_id = u.user_id""",
    "ranked": """
        SELECT *,
               row_number() OVER (PARTITION BY user_id ORDER BY "timestamp" ASC NULLS FIRST,
                   interactions_msid ASC NULLS FIRST, recording_mbid ASC NULLS FIRST) AS rn,
               count(*) OVER (PARTITION BY user_id) AS n
        FROM clean WHERE user_id IS NOT NULL""",
    "split": """
        SELECT user_id, interactions_msid, "timestamp", recording_mbid,
               rn <= CAST(trunc(n * CAST(0.8 AS DOUBLE)) AS BIGINT) AS is_train
        FROM ranked""",
    "train": """SELECT user_id, interactions_msid, "timestamp", recording_mbid
                FROM split WHERE is_train""",
    "validation": """SELECT user_id, interactions_msid, "timestamp", recording_mbid
                     FROM split WHERE NOT is_train""",
    "train_counts": """SELECT user_id, recording_mbid, count(*) AS "count"
                       FROM train GROUP BY user_id, recording_mbid""",
    "val_counts": """SELECT user_id, recording_mbid, count(*) AS "count"
                     FROM validation GROUP BY user_id, recording_mbid""",
    "train_rated": 'SELECT *, ln(2 + "count") AS rating FROM train_counts',
    "val_rated": 'SELECT *, ln(2 + "count") AS rating FROM val_counts',
    "item_index": """
        SELECT recording_mbid,
               CAST(dense_rank() OVER (ORDER BY recording_mbid ASC NULLS FIRST) - 1 AS BIGINT)
                   AS recording_mbid_index
        FROM (SELECT DISTINCT recording_mbid FROM train_rated) d""",
    "train_idx": """
        SELECT r.user_id, r."count", r.rating, x.recording_mbid_index
        FROM train_rated r LEFT JOIN item_index x ON r.recording_mbid = x.recording_mbid""",
    "val_idx_all": """
        SELECT r.user_id, r."count", r.rating, x.recording_mbid_index
        FROM val_rated r LEFT JOIN item_index x ON r.recording_mbid = x.recording_mbid""",
    # held-out items unseen in train are numbered after those of train
    "item_index_every": """
        SELECT * FROM item_index UNION ALL
        SELECT recording_mbid, (SELECT count(*) FROM item_index)
               + row_number() OVER (ORDER BY recording_mbid ASC NULLS FIRST) - 1
        FROM (SELECT DISTINCT recording_mbid FROM val_rated) v
        WHERE recording_mbid NOT IN (SELECT recording_mbid FROM item_index)""",
    "val_idx": """
        SELECT r.user_id, r."count", r.rating, x.recording_mbid_index
        FROM val_rated r LEFT JOIN item_index_every x ON r.recording_mbid = x.recording_mbid""",
    "pop": """
        SELECT recording_mbid, CAST(sum("count") AS BIGINT) AS recording_count,
               count(user_id) AS user_count
        FROM train_counts GROUP BY recording_mbid""",
    # popularity list, beta = 100000, 100 items
    "top_list": """
        SELECT recording_mbid, recording_count, user_count, average_count,
               row_number() OVER (ORDER BY average_count DESC NULLS LAST,
                                  recording_mbid ASC NULLS FIRST) AS position
        FROM (SELECT *, CAST(recording_count AS DOUBLE) / (user_count + 100000) AS average_count
              FROM pop)
        ORDER BY average_count DESC NULLS LAST, recording_mbid ASC NULLS FIRST LIMIT 100""",
    "nact": "SELECT user_id, count(*) AS n_actual FROM validation GROUP BY user_id",
    "hits": """
        SELECT user_id, position,
               row_number() OVER (PARTITION BY user_id ORDER BY position) AS hit
        FROM (SELECT DISTINCT v.user_id, t.position
              FROM validation v JOIN top_list t ON v.recording_mbid = t.recording_mbid)""",
    "hit_sums": """
        SELECT user_id, sum(hit / position) AS ap_s,
               sum(CASE WHEN position <= 10 THEN 1 ELSE 0 END) AS hk,
               sum(CASE WHEN position <= 10 THEN 1.0 / log2(position + 1) ELSE 0.0 END) AS dcg
        FROM hits GROUP BY user_id""",
    "idcg": """
        SELECT d.n_actual, sum(1.0 / log2(g + 1)) AS idcg
        FROM (SELECT DISTINCT n_actual FROM nact) d, generate_series(1, d.n_actual) gs(g)
        GROUP BY d.n_actual""",
    "user_metrics": """
        SELECT a.user_id,
               COALESCE(h.ap_s, 0) / a.n_actual AS ap,
               CAST(COALESCE(h.hk, 0) AS DOUBLE) / 10.0 AS pk,
               CASE WHEN i.idcg > 0 THEN COALESCE(h.dcg, 0) / i.idcg ELSE 0.0 END AS ndcg
        FROM nact a LEFT JOIN hit_sums h ON a.user_id = h.user_id
        LEFT JOIN idcg i ON a.n_actual = i.n_actual""",
    # bias model on all train ratings, scored on held-out pairs
    "mu": "SELECT avg(rating) AS mu FROM train_idx",
    "ib": """
        SELECT recording_mbid_index,
               sum(rating - (SELECT mu FROM mu)) / (count(*) + 5.0) AS item_bias
        FROM train_idx GROUP BY recording_mbid_index""",
    "ub": """
        SELECT t.user_id,
               sum(t.rating - (SELECT mu FROM mu) - COALESCE(ib.item_bias, 0))
                   / (count(*) + 5.0) AS user_bias
        FROM train_idx t LEFT JOIN ib ON t.recording_mbid_index = ib.recording_mbid_index
        GROUP BY t.user_id""",
    "bias_pred": f"""
        SELECT v.user_id, v.recording_mbid_index, v."count", v.rating,
               round((SELECT mu FROM mu) + COALESCE(ib.item_bias, 0) + COALESCE(ub.user_bias, 0), {D})
                   AS prediction
        FROM val_idx v LEFT JOIN ib ON v.recording_mbid_index = ib.recording_mbid_index
        LEFT JOIN ub ON v.user_id = ub.user_id""",
    "truth5": """
        SELECT * FROM (SELECT user_id, recording_mbid_index, rating,
            row_number() OVER (PARTITION BY user_id ORDER BY rating DESC NULLS LAST,
                               recording_mbid_index ASC NULLS FIRST) AS rank FROM val_idx)
        WHERE rank <= 5""",
    "pred5": """
        SELECT * FROM (SELECT user_id, recording_mbid_index, prediction,
            row_number() OVER (PARTITION BY user_id ORDER BY prediction DESC NULLS LAST,
                               recording_mbid_index ASC NULLS FIRST) AS rank FROM bias_pred)
        WHERE rank <= 5""",
    "truth100": """
        SELECT * FROM (SELECT user_id, recording_mbid_index, rating,
            row_number() OVER (PARTITION BY user_id ORDER BY rating DESC NULLS LAST,
                               recording_mbid_index ASC NULLS FIRST) AS rank FROM val_idx)
        WHERE rank <= 100""",
    "paired5": """
        SELECT t.user_id, t.recording_mbid_index AS true_item, p.recording_mbid_index AS pred_item
        FROM truth5 t JOIN pred5 p ON t.user_id = p.user_id AND t.rank = p.rank""",
    "paired100": """
        SELECT t.user_id, t.recording_mbid_index AS true_item, p.recording_mbid_index AS pred_item
        FROM truth100 t JOIN seen100 p ON t.user_id = p.user_id AND t.rank = p.rank""",
    # exact 10% sample of the indexed train ratings, seed 42
    "sample10": """
        SELECT user_id, recording_mbid_index, "count", rating FROM (
            SELECT *, row_number() OVER (ORDER BY md5(concat_ws('|', CAST(user_id AS VARCHAR),
                           CAST(recording_mbid_index AS VARCHAR), '42')),
                       user_id ASC NULLS FIRST, recording_mbid_index ASC NULLS FIRST) - 1 AS pos,
                   count(*) OVER () AS total
            FROM train_idx)
        WHERE pos < round_even(total * CAST(0.1 AS DOUBLE), 0)""",
    "s_mu": "SELECT avg(rating) AS mu FROM sample10",
    "s_ib": """
        SELECT recording_mbid_index,
               sum(rating - (SELECT mu FROM s_mu)) / (count(*) + 5.0) AS item_bias
        FROM sample10 GROUP BY recording_mbid_index""",
    "s_ub": """
        SELECT t.user_id,
               sum(t.rating - (SELECT mu FROM s_mu) - COALESCE(ib.item_bias, 0))
                   / (count(*) + 5.0) AS user_bias
        FROM sample10 t LEFT JOIN s_ib ib ON t.recording_mbid_index = ib.recording_mbid_index
        GROUP BY t.user_id""",
    "s_pred": f"""
        SELECT v.user_id, v.recording_mbid_index, v.rating,
               round((SELECT mu FROM s_mu) + COALESCE(ib.item_bias, 0) + COALESCE(ub.user_bias, 0), {D})
                   AS prediction
        FROM val_idx v LEFT JOIN s_ib ib ON v.recording_mbid_index = ib.recording_mbid_index
        LEFT JOIN s_ub ub ON v.user_id = ub.user_id""",
    "s_top": """
        SELECT * FROM (SELECT user_id, recording_mbid_index,
            row_number() OVER (PARTITION BY user_id ORDER BY prediction DESC NULLS LAST,
                               recording_mbid_index ASC NULLS FIRST) AS rank FROM s_pred)
        WHERE rank <= 100""",
    "s_hits": """
        SELECT p.user_id, p.rank,
               row_number() OVER (PARTITION BY p.user_id ORDER BY p.rank) AS hit
        FROM s_top p JOIN (SELECT DISTINCT user_id, recording_mbid_index FROM truth100) t
          ON p.user_id = t.user_id AND p.recording_mbid_index = t.recording_mbid_index""",
    "s_ap": """
        SELECT u.user_id,
               CASE WHEN h.s IS NOT NULL THEN h.s / l.tlen ELSE 0.0 END AS ap
        FROM (SELECT DISTINCT user_id FROM s_top) u
        LEFT JOIN (SELECT user_id, sum(hit / rank) AS s FROM s_hits GROUP BY user_id) h
          ON u.user_id = h.user_id
        LEFT JOIN (SELECT user_id, count(*) AS tlen FROM truth100 GROUP BY user_id) l
          ON u.user_id = l.user_id""",
    "truth_null": """
        SELECT * FROM (SELECT user_id, recording_mbid_index, rating,
            row_number() OVER (PARTITION BY user_id ORDER BY rating DESC NULLS LAST,
                               recording_mbid_index ASC NULLS FIRST) AS rank FROM val_idx_all)
        WHERE rank <= 5""",
    "pred_null": """
        SELECT * FROM (SELECT user_id, recording_mbid_index,
            row_number() OVER (PARTITION BY user_id
                               ORDER BY "count" % 3 + recording_mbid_index % 10 DESC NULLS LAST,
                               recording_mbid_index ASC NULLS FIRST) AS rank FROM val_idx_all)
        WHERE rank <= 5""",
    "paired_null": """
        SELECT t.user_id, t.recording_mbid_index AS true_item, p.recording_mbid_index AS pred_item
        FROM truth_null t JOIN pred_null p ON t.user_id = p.user_id AND t.rank = p.rank""",
    # predictions for the items of the train half only
    "seen100": """
        SELECT * FROM (SELECT user_id, recording_mbid_index,
            row_number() OVER (PARTITION BY user_id ORDER BY prediction DESC NULLS LAST,
                               recording_mbid_index ASC NULLS FIRST) AS rank FROM bias_pred
            WHERE recording_mbid_index IN (SELECT recording_mbid_index FROM item_index))
        WHERE rank <= 100""",
    "scorable": """
        SELECT * FROM val_idx WHERE recording_mbid_index IN (SELECT recording_mbid_index FROM item_index)
          AND user_id IN (SELECT user_id FROM train_idx)""",
    "list_lengths": """
        SELECT user_id, least(count(*), 5) AS n FROM val_idx GROUP BY user_id""",
    "scored_lengths": """
        SELECT user_id, least(count(*), 5) AS n FROM scorable GROUP BY user_id""",
    "recency_val_in": 'SELECT user_id, recording_mbid, "timestamp" FROM validation',
    "recency_in": 'SELECT user_id, recording_mbid, "timestamp" FROM train',
    "labelled": """
        SELECT prediction, CASE WHEN "count" >= 2.0 THEN 1.0 ELSE 0.0 END AS label
        FROM bias_pred""",
    "auc_scores": """
        SELECT prediction AS s,
               sum(CASE WHEN label = 1.0 THEN 1 ELSE 0 END) AS pos,
               sum(CASE WHEN label = 1.0 THEN 0 ELSE 1 END) AS neg
        FROM labelled WHERE prediction IS NOT NULL AND label IS NOT NULL GROUP BY prediction""",
    "auc_terms": """
        SELECT pos, neg,
               COALESCE(sum(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
                   AS before_neg
        FROM auc_scores""",
}


def _recency(source: str, per_item: bool = False) -> str:
    part = "user_id, recording_mbid" if per_item else "user_id"
    ties = '' if per_item else ', recording_mbid ASC NULLS FIRST'
    return f"""
        SELECT user_id, recording_mbid, "timestamp", position, round(exp(1 - position), {D}) AS recency
        FROM (SELECT *, row_number() OVER (PARTITION BY {part}
                  ORDER BY "timestamp" DESC NULLS LAST{ties}) AS position FROM {source})"""


for _name in ("s_top", "s_hits", "s_ap"):  # the list metrics with lists of 5
    CTES[_name.replace("s_", "s5_")] = (
        CTES[_name].replace("<= 100", "<= 5").replace("truth100", "truth5")
        .replace("s_top", "s5_top").replace("s_hits", "s5_hits"))
CTES["recency_rows"] = _recency("recency_in")
CTES["recency_val_rows"] = _recency("recency_val_in")
CTES["recency_item_rows"] = _recency("recency_in", per_item=True)
CTES["event_log"] = """
    SELECT user_id, props AS recording_mbid, ts AS "timestamp" FROM events"""
CTES["recency_event_rows"] = _recency("event_log")

_NAMES = sorted(CTES, key=len, reverse=True)


def _refs(sql: str) -> list[str]:
    return [n for n in _NAMES if re.search(rf"\b{re.escape(n)}\b", sql)]


def _with(body: str, unseen: bool = False) -> str:
    """Prefix ``body`` with the CTEs it needs, dependencies first.

    ``unseen`` leaves the items whose number 7 divides out of the train half.
    """
    ctes = dict(CTES)
    if unseen:
        ctes["train"] += " AND CAST(substr(recording_mbid, 2) AS BIGINT) % 7 <> 0"
    ordered: list[str] = []

    def visit(name: str, seen: set[str]) -> None:
        if name in ordered or name in seen:
            return
        seen.add(name)
        for dep in _refs(ctes[name]):
            if dep != name:
                visit(dep, seen)
        ordered.append(name)

    for name in _refs(body):
        visit(name, set())
    if not ordered:
        return body
    defs = ",\n".join(f"{n} AS ({ctes[n]})" for n in ordered)
    return f"WITH {defs}\n{body}"


def _pop(beta: int) -> str:
    return f"""
        SELECT recording_mbid, recording_count, user_count, average_count,
               CAST(row_number() OVER (ORDER BY average_count DESC NULLS LAST,
                                       recording_mbid ASC NULLS FIRST) AS BIGINT) AS position
        FROM (SELECT *, CAST(recording_count AS DOUBLE) / (user_count + {beta}) AS average_count
              FROM pop)
        ORDER BY average_count DESC NULLS LAST, recording_mbid ASC NULLS FIRST LIMIT 100"""


def _overlap_rows(paired: str) -> str:
    """Per user: distinct true items also predicted (among paired rows; a null item is
    an item like any other) / paired rows."""
    return f"""
        SELECT a.user_id,
               count(DISTINCT CASE WHEN EXISTS (SELECT 1 FROM {paired} b
                     WHERE b.user_id = a.user_id AND b.pred_item IS NOT DISTINCT FROM a.true_item)
                     THEN coalesce(a.true_item, -1) END) AS common_count,
               count(*) AS true_count
        FROM {paired} a GROUP BY a.user_id"""


def _overlap_cols(paired: str) -> str:
    return f"""SELECT user_id, common_count, true_count,
               round(CASE WHEN true_count > 0 THEN common_count / true_count END, {D})
                   AS common_percentage FROM ({_overlap_rows(paired)})"""


def _overlap_mean(paired: str) -> str:
    return f"""SELECT round(avg(CASE WHEN true_count > 0 THEN common_count / true_count END), {D})
               AS overlap FROM ({_overlap_rows(paired)})"""


SQL: dict[str, str] = {
    "clean_interactions": "SELECT * FROM clean",
    "null_fallback": """SELECT recording_mbid, count(*) AS events FROM clean
                        WHERE recording_mbid = interactions_msid GROUP BY recording_mbid""",
    "temporal_split": "SELECT * FROM split",
    "train_rows": "SELECT * FROM train",
    "validation_rows": "SELECT * FROM validation",
    "split_points": """SELECT user_id, count(*) AS n,
                       CAST(trunc(count(*) * CAST(0.8 AS DOUBLE)) AS BIGINT) AS split_point
                       FROM clean WHERE user_id IS NOT NULL GROUP BY user_id""",
    "interaction_counts": "SELECT * FROM train_counts",
    "validation_counts": "SELECT * FROM val_counts",
    "item_popularity": """SELECT recording_mbid, recording_count, user_count,
                          CAST(recording_count AS DOUBLE) / (user_count + 100000) AS average_count
                          FROM pop""",
    "popularity_topk_beta0": _pop(0),
    "popularity_topk_beta100": _pop(100),
    "popularity_topk": _pop(100000),
    "compress_counts": f'SELECT user_id, recording_mbid, "count", round(rating, {D}) AS rating FROM train_rated',
    "recency_weight": "SELECT * FROM recency_rows",
    "recency_validation": "SELECT * FROM recency_val_rows",
    "recency_ratings": """
        SELECT r.user_id, x.recording_mbid_index, r."timestamp", r.recency AS rating
        FROM recency_val_rows r LEFT JOIN item_index_every x ON r.recording_mbid = x.recording_mbid""",
    "recency_per_item": "SELECT * FROM recency_item_rows",
    "recency_events": "SELECT * FROM recency_event_rows",
    "compress_recency": f"""
        SELECT user_id, recording_mbid, "timestamp", round(recency_raw, {D}) AS recency,
               round(ln(2 + recency_raw), {D}) AS rating
        FROM (SELECT *, exp(1 - row_number() OVER (PARTITION BY user_id
                ORDER BY "timestamp" DESC NULLS LAST, recording_mbid ASC NULLS FIRST)) AS recency_raw
              FROM recency_in) r""",
    "item_index": "SELECT * FROM item_index",
    "apply_item_index": f"""SELECT user_id, "count", round(rating, {D}) AS rating,
                            recording_mbid_index FROM val_idx_all""",
    "sample_exact": 'SELECT user_id, recording_mbid_index, "count" FROM sample10',
    "csv_ratings": f"SELECT user_id, recording_mbid_index, round(rating, {D}) AS rating FROM train_idx",
    "top_n_by_rating": f"""
        SELECT user_id, recording_mbid_index, "count", round(rating, {D}) AS rating,
               CAST(rank AS BIGINT) AS rank FROM (
            SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY rating DESC NULLS LAST,
                                         recording_mbid_index ASC NULLS FIRST) AS rank
            FROM val_idx) WHERE rank <= 5""",
    "average_precision": f"SELECT user_id, round(ap, {D}) AS ap FROM user_metrics",
    "precision_at_k": f"SELECT user_id, round(pk, {D}) AS pk FROM user_metrics",
    "ndcg_at_k": f"SELECT user_id, round(ndcg, {D}) AS ndcg FROM user_metrics",
    "ranking_summary": f"""SELECT round(avg(ap), {D}) AS mean_map, round(avg(pk), {D}) AS mean_pk,
                           round(avg(ndcg), {D}) AS mean_ndcg FROM user_metrics""",
    "bias_predict": f"""SELECT user_id, recording_mbid_index, "count", round(rating, {D}) AS rating,
                        prediction FROM bias_pred""",
    "top_n_by_prediction": "SELECT user_id, recording_mbid_index, prediction, CAST(rank AS BIGINT) AS rank FROM pred5",
    "overlap_at_5": _overlap_cols("paired5"),
    "overlap_mean": _overlap_mean("paired5"),
    "overlap_percent_at_5": f"""SELECT user_id,
        round(CASE WHEN true_count > 0 THEN common_count / true_count * 100.0 END, {D})
            AS common_percentage FROM ({_overlap_rows("paired5")})""",
    "overlap_mean_100": _overlap_mean("paired100"),
    "list_map": f"SELECT count(*) AS users, round(avg(ap), {D}) AS list_map FROM s_ap",
    "list_ap": f"SELECT user_id, round(ap, {D}) AS ap FROM s_ap",
    "item_bias": f"SELECT recording_mbid_index, round(item_bias, {D}) AS item_bias FROM ib",
    "user_bias": f"SELECT user_id, round(user_bias, {D}) AS user_bias FROM ub",
    "threshold_label": f"""SELECT user_id, recording_mbid_index, round(rating, {D}) AS rating,
                           CAST(CASE WHEN "count" >= 2 THEN 1.0 ELSE 0.0 END AS DOUBLE) AS label
                           FROM val_idx""",
    "auc_exact": f"""
        SELECT round(CASE WHEN sum(pos) > 0 AND sum(neg) > 0
                          THEN sum(pos * (before_neg + neg * 0.5))
                               / (CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE)) END, {D}) AS auc,
               CAST(COALESCE(sum(pos), 0) AS BIGINT) AS positives,
               CAST(COALESCE(sum(neg), 0) AS BIGINT) AS negatives
        FROM auc_terms""",
    # what holds for any right fit: the scored pairs, dot products of factors that are not
    # negative, and factors that solve their least squares
    "als_predict": f"""SELECT user_id, recording_mbid_index, "count", round(rating, {D}) AS rating,
                       true AS nonnegative, true AS is_product FROM scorable""",
    "als_overlap": """SELECT l.user_id, least(l.n, s.n) AS true_count, true AS within, true AS optimal
                      FROM list_lengths l JOIN scored_lengths s ON l.user_id = s.user_id""",
    "als_recency_auc": """
        SELECT count(*) FILTER (WHERE position <= 3) AS positives,
               count(*) FILTER (WHERE position > 3) AS negatives, true AS auc_defined, true AS optimal
        FROM recency_val_rows r JOIN item_index x ON r.recording_mbid = x.recording_mbid
        WHERE r.user_id IN (SELECT user_id FROM train)""",
    "als_optimal": "SELECT user_id, count(*) AS n_ratings, true AS optimal FROM train_idx GROUP BY user_id",
    "recency_als_optimal": """SELECT user_id, count(DISTINCT recording_mbid) AS n_ratings, true AS optimal
                              FROM train GROUP BY user_id""",
    "event_als_optimal": "SELECT user_id, count(*) AS n_ratings, true AS optimal FROM train GROUP BY user_id",
    "sample_bernoulli": """
        SELECT user_id, recording_mbid_index, "count" FROM train_idx
        WHERE CAST('0x' || substr(md5(concat_ws('|', CAST(user_id AS VARCHAR),
                  CAST(recording_mbid_index AS VARCHAR), '42')), 1, 8) AS BIGINT)
              < CAST(ceil(CAST(0.9 AS DOUBLE) * 4294967296) AS BIGINT)""",
    "overwritten_ratings": f"SELECT user_id, recording_mbid_index, round(rating, {D}) AS rating FROM val_idx",
}

# the same statements over a train half without some items
SQL_UNSEEN: dict[str, str] = {
    "unseen_item_index": f"""SELECT user_id, "count", round(rating, {D}) AS rating,
                             recording_mbid_index FROM val_idx""",
    "unseen_bias_predict": SQL["bias_predict"],
    "unseen_overlap_at_5": SQL["overlap_at_5"],
    "unseen_list_map": SQL["list_map"].replace("s_ap", "s5_ap"),
    "unseen_list_ap": SQL["list_ap"].replace("s_ap", "s5_ap"),
    "unseen_overlap_mean_100": SQL["overlap_mean_100"],
    "unseen_overlap_null_items": _overlap_cols("paired_null"),
    "unseen_als_predict": SQL["als_predict"],
    "unseen_als_overlap": SQL["als_overlap"],
    "unseen_als_recency_auc": SQL["als_recency_auc"],
}

ORACLE_SQL: dict[str, str] = {
    **{name: _with(body) for name, body in SQL.items()},
    **{name: _with(body, unseen=True) for name, body in SQL_UNSEEN.items()},
}
