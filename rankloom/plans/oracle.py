"""DuckDB SQL equal to each registered query (the correctness oracle).

Doubles are rounded to 6 digits on both sides.  DuckDB spellings to remember:
``ln`` is the natural log (``log`` is base 10), and ``0.0`` is a DECIMAL, so double
literals in outputs are cast.
"""

from __future__ import annotations

import re

from rankloom.operators.docs import ENGLISH_STOP_WORDS
from rankloom.sources.testdata import VIEWS, duck_with


def hb(expr: str, seed: int, buckets: int) -> str:
    """The seeded md5 bucket of ``functions.keys.hash_bucket`` in DuckDB."""
    return (f"((('0x' || substr(md5(CAST({expr} AS VARCHAR) || ':{seed}'), 1, 8))::BIGINT) "
            f"% {buckets})")


def md5key(expr: str, seed: int = 42) -> str:
    return f"md5(CAST({expr} AS VARCHAR) || ':{seed}')"


PAIR = "(CAST(userId AS VARCHAR) || '|' || CAST(itemId AS VARCHAR))"
NORM = "sqrt(list_dot_product({0}, {0}))"
VALID = ("reviewerID IS NOT NULL AND asin IS NOT NULL AND overall IS NOT NULL "
         "AND overall >= 1.0 AND overall <= 5.0")
SEGMENT = ("CASE WHEN {0} > 20 THEN 'power user' WHEN {0} > 5 THEN 'regular user' "
           "ELSE 'cold-start' END")
STOP_LIST = "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in ENGLISH_STOP_WORDS) + "]"
TOKENS = ("CASE WHEN lower({0}) = '' THEN [''] "
          "WHEN regexp_replace(lower({0}), '\\s+$', '') = '' THEN []::VARCHAR[] "
          "ELSE string_split_regex(regexp_replace(lower({0}), '\\s+$', ''), '\\s') END")

# Common table expressions; a query names the ones it needs (dependencies follow).
CTES: dict[str, str] = {
    "clean": f"SELECT reviewerID, asin, overall, verified, reviewText, summary, unixReviewTime "
             f"FROM reviews WHERE {VALID}",
    "uidx": "SELECT reviewerID, CAST(rank() OVER (ORDER BY reviewerID) - 1 AS BIGINT) AS userIndex "
            "FROM (SELECT DISTINCT reviewerID FROM clean) k",
    "iidx": "SELECT asin, CAST(rank() OVER (ORDER BY asin) - 1 AS BIGINT) AS itemIndex "
            "FROM (SELECT DISTINCT asin FROM clean) k",
    "docs": "SELECT asin, string_agg(text, ' ' ORDER BY unixReviewTime, reviewerID, md5(text)) AS combinedText, "
            "count(*) AS reviewCount, avg(overall) AS avgRating "
            "FROM (SELECT asin, unixReviewTime, reviewerID, overall, COALESCE(reviewText, summary) AS text "
            "FROM clean WHERE reviewText IS NOT NULL OR summary IS NOT NULL) t "
            "GROUP BY asin HAVING sum(length(text)) + count(*) - 1 > 10",
    "parts": "SELECT asin, unixReviewTime, reviewerID, md5(text) AS partKey, overall, text, "
             "length(text) AS chars, string_split_regex(lower(text), '\\s') AS raw, "
             "length(text) - length(regexp_replace(text, '\\s+$', '')) AS blanks "
             "FROM (SELECT asin, unixReviewTime, reviewerID, overall, COALESCE(reviewText, summary) AS text "
             "FROM clean WHERE reviewText IS NOT NULL OR summary IS NOT NULL) c",
    "ptok": f"SELECT *, list_filter(raw, lambda x: NOT list_contains({STOP_LIST}, x)) AS tk, "
            "CAST(blanks + CASE WHEN blanks = chars THEN 1 ELSE 0 END AS BIGINT) AS endEmpties FROM parts",
    "tstat": "SELECT asin, count(*) AS reviewCount, avg(overall) AS avgRating, "
             "CAST(sum(chars) + count(*) - 1 AS BIGINT) AS docChars, "
             "CAST(sum(len(tk)) - max_by(endEmpties, {'t': unixReviewTime, 'r': reviewerID, 'k': partKey}) "
             "AS BIGINT) AS docTokens FROM ptok GROUP BY asin",
    "embi": "SELECT * FROM tstat WHERE docChars > 50 AND reviewCount >= 5 AND docTokens > 3",
    "mrat": "SELECT CAST(u.userIndex AS INT) AS userId, CAST(i.itemIndex AS INT) AS itemId, "
            "CAST(c.overall AS FLOAT) AS rating FROM clean c JOIN uidx u USING (reviewerID) "
            "JOIN iidx i USING (asin)",
    "mact": "SELECT userId, count(*) AS n FROM mrat GROUP BY userId",
    "mside": f"SELECT *, {hb("(userId || '|' || itemId || '|' || CAST(rating AS VARCHAR))", 42, 10000)} < 8000 "
             "AS train FROM mrat WHERE userId IN (SELECT userId FROM mact WHERE n >= 5)",
    "mtrain": "SELECT * FROM mside WHERE train",
    "vocab": "SELECT word FROM (SELECT unnest(tk) AS word FROM ptok WHERE asin IN (SELECT asin FROM embi)) w "
             "GROUP BY word HAVING count(*) >= 50",
    "act": "SELECT userId, count(*) AS userRatingCount FROM ratings GROUP BY userId",
    "pop": "SELECT itemId, count(*) AS itemRatingCount FROM ratings GROUP BY itemId",
    "active": "SELECT userId, itemId, rating FROM ratings WHERE userId IN ("
              "SELECT userId FROM ratings WHERE userId IS NOT NULL AND itemId IS NOT NULL "
              "AND rating IS NOT NULL AND NOT isnan(rating) GROUP BY userId HAVING count(*) >= 5) "
              "AND itemId IS NOT NULL AND rating IS NOT NULL AND NOT isnan(rating)",
    "istat": "SELECT itemId, avg(CAST(rating AS DOUBLE)) AS itemAvgRating, "
             "count(*) AS itemReviewCount FROM ratings GROUP BY itemId",
    "items": "SELECT e.itemId, e.embedding, COALESCE(s.itemAvgRating, 3.0) AS itemAvgRating, "
             "COALESCE(s.itemReviewCount, 1) AS itemReviewCount "
             "FROM item_emb e LEFT JOIN istat s USING (itemId)",
    "seg": "SELECT userId, userRatingCount, "
           "CASE WHEN userRatingCount >= 6 THEN 'warm' ELSE 'cold' END AS segment FROM act",
    "cold": "SELECT userId FROM seg WHERE segment = 'cold'",
    "warm": "SELECT userId FROM seg WHERE segment = 'warm'",
    "rated": "SELECT r.userId, r.itemId, CAST(r.rating AS DOUBLE) AS w, i.embedding "
             "FROM ratings r JOIN cold USING (userId) JOIN items i USING (itemId)",
    "psum": "SELECT userId, pos, sum(v * w) AS s FROM (SELECT userId, w, unnest(embedding) AS v, "
            "unnest(range(len(embedding))) AS pos FROM rated) t GROUP BY userId, pos",
    "pw": "SELECT userId, sum(w) AS tw FROM rated GROUP BY userId",
    "prof": "SELECT p.userId, list(CASE WHEN tw > 0 THEN s / tw ELSE s END ORDER BY pos) AS profile "
            "FROM psum p JOIN pw USING (userId) GROUP BY p.userId",
    "pool": "SELECT i.itemId, i.embedding, i.itemAvgRating, "
            "COALESCE(p.itemRatingCount, 1) AS itemRatingCount, "
            "ln(CAST(COALESCE(p.itemRatingCount, 1) AS DOUBLE) + 1.0) AS logItemPop "
            "FROM items i LEFT JOIN pop p USING (itemId) WHERE COALESCE(p.itemRatingCount, 1) >= 10 "
            "ORDER BY itemRatingCount DESC, itemId LIMIT 1000",
    "cold_scored": f"""SELECT u.userId, c.itemId,
       round(CASE WHEN {NORM.format('u.profile')} = 0 OR {NORM.format('c.embedding')} = 0 THEN 0.0
                  ELSE list_dot_product(u.profile, c.embedding)
                       / ({NORM.format('u.profile')} * {NORM.format('c.embedding')}) END * 0.60
             + (c.itemAvgRating / 5.0) * 0.25 + (c.logItemPop / 10.0) * 0.15, 6) AS hybridScore,
       {NORM.format('c.embedding')} AS w2vScore
FROM prof u CROSS JOIN pool c
WHERE NOT EXISTS (SELECT 1 FROM rated r WHERE r.userId = u.userId AND r.itemId = c.itemId)""",
    "cold_recs": """SELECT userId, itemId, hybridScore, CAST(0.0 AS DOUBLE) AS alsScore,
       round(w2vScore, 6) AS w2vScore, 'w2v_personalized' AS source, rank
FROM (SELECT *, CAST(row_number() OVER (PARTITION BY userId ORDER BY hybridScore DESC, itemId) AS INT)
      AS rank FROM cold_scored) t WHERE rank <= 10""",
    "nop": "SELECT c.userId FROM cold c WHERE NOT EXISTS (SELECT 1 FROM prof p WHERE p.userId = c.userId)",
    "ptop": f"""SELECT p.itemId,
       round(ln(CAST(p.itemRatingCount AS DOUBLE) + 1.0) * 0.5 + COALESCE(i.itemAvgRating, 3.0) * 0.3
             + (CASE WHEN i.embedding IS NULL THEN 0.0 ELSE {NORM.format('i.embedding')} END) * 0.2, 6)
         AS hybridScore,
       CASE WHEN i.embedding IS NULL THEN 0.0 ELSE {NORM.format('i.embedding')} END AS w2vScore
FROM pop p LEFT JOIN items i USING (itemId) ORDER BY hybridScore DESC, itemId LIMIT 10""",
    "fb_recs": """SELECT u.userId, t.itemId, t.hybridScore, CAST(0.0 AS DOUBLE) AS alsScore,
       round(t.w2vScore, 6) AS w2vScore, 'popularity_fallback' AS source,
       CAST(row_number() OVER (PARTITION BY u.userId ORDER BY t.hybridScore DESC, t.itemId) AS INT) AS rank
FROM nop u CROSS JOIN ptop t""",
    "mm": "SELECT userId, itemId, CASE WHEN mx = mn THEN 0.5 ELSE (alsRawScore - mn) / (mx - mn) END "
          "AS alsScore FROM (SELECT *, min(alsRawScore) OVER (PARTITION BY userId) AS mn, "
          "max(alsRawScore) OVER (PARTITION BY userId) AS mx FROM candidates) t",
    "feats": f"""SELECT m.userId, m.itemId, m.alsScore,
       CASE WHEN i.embedding IS NULL THEN 0.0 ELSE {NORM.format('i.embedding')} END AS w2vScore,
       ln(CAST(COALESCE(p.itemRatingCount, 1) AS DOUBLE) + 1.0) AS logItemPop,
       ln(CAST(COALESCE(a.userRatingCount, 1) AS DOUBLE) + 1.0) AS logUserActivity,
       COALESCE(i.itemAvgRating, 3.0) AS itemAvgRating,
       COALESCE(a.userRatingCount, 1) AS userRatingCount,
       COALESCE(p.itemRatingCount, 1) AS itemRatingCount,
       COALESCE(i.itemReviewCount, 1) AS itemReviewCount
FROM mm m LEFT JOIN items i USING (itemId) LEFT JOIN act a USING (userId) LEFT JOIN pop p USING (itemId)""",
    "labeled": """SELECT f.*, CASE WHEN h.hit = 1 THEN CAST(1.0 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END AS label
FROM feats f LEFT JOIN (SELECT DISTINCT userId, itemId, 1 AS hit FROM ratings
                        WHERE userId IN (SELECT userId FROM warm)) h USING (userId, itemId)""",
    "lc": "SELECT count(*) FILTER (WHERE label = 1.0) AS positives, "
          "count(*) FILTER (WHERE label = 0.0) AS negatives FROM labeled",
    "warm_sb": """SELECT c.userId, c.itemId, c.alsRawScore AS hybridScore, m.alsScore,
       CAST(0.0 AS DOUBLE) AS w2vScore, 'als_gbt' AS source,
       CAST(row_number() OVER (PARTITION BY c.userId ORDER BY c.alsRawScore DESC, c.itemId) AS INT) AS rank
FROM candidates c JOIN mm m USING (userId, itemId)""",
    "samp": f"SELECT userId FROM (SELECT userId, row_number() OVER (ORDER BY {md5key('userId')}, userId) "
            f"AS n, count(*) OVER () AS total FROM (SELECT DISTINCT userId FROM ratings) k) t "
            f"WHERE n <= total // 10",
    "enr": """SELECT r.userId, r.rank, r.itemId,
       COALESCE(x.asin, 'UNKNOWN_' || CAST(r.itemId AS VARCHAR)) AS asin,
       round(r.hybridScore, 4) AS hybridScore, round(r.alsScore, 4) AS alsScore,
       round(r.w2vScore, 4) AS w2vScore, r.source,
       round(COALESCE(d.avgRating, 0.0), 2) AS avgRating, CAST(COALESCE(d.reviewCount, 0) AS BIGINT) AS reviewCount,
       'https://www.amazon.com/dp/' || COALESCE(x.asin, 'UNKNOWN_' || CAST(r.itemId AS VARCHAR)) AS amazonUrl
FROM recs r LEFT JOIN iidx x ON CAST(x.itemIndex AS INT) = r.itemId
LEFT JOIN docs d ON d.asin = COALESCE(x.asin, 'UNKNOWN_' || CAST(r.itemId AS VARCHAR))""",
}
CTE_ORDER = list(CTES)
FIXTURE_VIEWS = tuple(VIEWS)


def _refers(text: str, name: str) -> bool:
    return re.search(rf"\b{name}\b", text) is not None


def sql(body: str, *ctes: str) -> str:
    """Oracle text: needed fixture views + the named CTEs (with dependencies) + body."""
    need: set[str] = set()

    def visit(n: str) -> None:
        if n in need:
            return
        need.add(n)
        for other in CTE_ORDER:
            if other != n and _refers(CTES[n], other):
                visit(other)

    for c in CTE_ORDER:
        if c in ctes or _refers(body, c):
            visit(c)
    texts = [CTES[n] for n in need] + [body]
    views = [v for v in FIXTURE_VIEWS if any(_refers(t, v) for t in texts)]
    local = ",\n".join(f"{n} AS ({CTES[n]})"
                       for n in CTE_ORDER if n in need)
    head = duck_with(views, "SELECT 1")
    head = head[: head.rfind("SELECT 1")].rstrip()
    if local:
        head = f"{head},\n{local}" if head else f"WITH {local}"
    return f"{head}\n{body.strip()}"


def r6(col: str, alias: str | None = None) -> str:
    return f"round({col}, 6) AS {alias or col.split('.')[-1]}"


ORACLE: dict[str, str] = {
    # preprocessing
    "clean_reviews": sql("SELECT * FROM clean"),
    "reviews_json_scan": sql("SELECT * FROM clean"),
    "review_rejects": sql(f"""SELECT count(*) AS rawRows, count(*) FILTER (WHERE {VALID}) AS cleanRows,
       count(*) FILTER (WHERE reviewerID IS NULL) AS nullReviewer,
       count(*) FILTER (WHERE asin IS NULL) AS nullItem,
       count(*) FILTER (WHERE overall IS NULL) AS nullRating,
       count(*) FILTER (WHERE overall IS NOT NULL AND NOT (overall >= 1.0 AND overall <= 5.0))
         AS ratingOutOfRange
FROM reviews"""),
    "user_index": sql("SELECT * FROM uidx"),
    "item_index": sql("SELECT * FROM iidx"),
    "ratings": sql("""SELECT CAST(u.userIndex AS INT) AS userId, CAST(i.itemIndex AS INT) AS itemId,
       CAST(c.overall AS FLOAT) AS rating, c.unixReviewTime AS timestamp
FROM clean c JOIN uidx u USING (reviewerID) JOIN iidx i USING (asin)"""),
    "item_document_chunks": sql("SELECT asin, combinedText, true AS gapless, true AS bounded FROM docs"),
    "item_documents": sql(f"SELECT asin, combinedText, reviewCount, {r6('avgRating')} FROM docs"),
    "item_text_stats": sql(f"SELECT asin, reviewCount, {r6('avgRating')}, docChars FROM tstat WHERE docChars > 10"),
    "part_tokens": sql("SELECT asin, unixReviewTime, reviewerID, partKey, CAST(len(tk) AS BIGINT) AS nTokens, "
                       "endEmpties, array_to_string(tk, ' ') AS tokensText FROM ptok"),
    "embeddable_items": sql(f"SELECT asin, reviewCount, {r6('avgRating')}, docChars, docTokens FROM embi"),
    "embeddable_parts": sql("SELECT asin, partKey, CAST(len(tk) AS BIGINT) AS nTokens FROM ptok "
                            "WHERE asin IN (SELECT asin FROM embi)"),
    "index_extension": sql("""SELECT asin, CAST(row_number() OVER (ORDER BY even DESC, asin) - 1 AS BIGINT) AS itemIndex
FROM (SELECT DISTINCT asin, asin[-1] IN ('0', '2', '4', '6', '8') AS even FROM clean) k"""),
    "item_tokens": sql(f"""SELECT asin, CAST(len(tk) AS BIGINT) AS tokenCount, array_to_string(tk, ' ') AS tokensText
FROM (SELECT asin, {TOKENS.format('combinedText')} AS tk FROM docs) t"""),
    "item_tokens_nostop": sql(f"""SELECT asin, CAST(len(tk) AS BIGINT) AS tokenCount, array_to_string(tk, ' ') AS tokensText
FROM (SELECT asin, list_filter({TOKENS.format('combinedText')}, lambda x: NOT list_contains({STOP_LIST}, x)) AS tk
      FROM docs WHERE reviewCount >= 5 AND length(combinedText) > 50) t
WHERE len(tk) > 3"""),
    "user_activity": sql("SELECT * FROM act"),
    "item_popularity": sql("SELECT * FROM pop"),
    "active_ratings": sql("SELECT * FROM active"),
    "dataset_counts": sql("""SELECT r.*, a.* FROM
 (SELECT count(*) AS totalRatings, count(DISTINCT userId) AS totalUsers, count(DISTINCT itemId) AS totalItems
  FROM ratings) r,
 (SELECT count(*) FILTER (WHERE userRatingCount <= 5) AS coldUsers,
         count(*) FILTER (WHERE userRatingCount > 5) AS warmUsers,
         count(*) FILTER (WHERE userRatingCount > 20) AS powerUsers FROM act) a"""),
    "parquet_roundtrip": sql("SELECT * FROM ratings"),
    # vectors
    "embedding_norm": sql(f"SELECT itemId, round({NORM.format('embedding')}, 6) AS norm FROM items"),
    "embedding_cosine": sql(f"""SELECT r.userId, r.itemId,
       round(CASE WHEN {NORM.format('p.profile')} = 0 OR {NORM.format('r.embedding')} = 0 THEN 0.0
             ELSE list_dot_product(p.profile, r.embedding)
                  / ({NORM.format('p.profile')} * {NORM.format('r.embedding')}) END, 6) AS cosine
FROM rated r JOIN prof p USING (userId)"""),
    "embedding_dot": sql("""SELECT r.userId, r.itemId, round(list_dot_product(p.profile, r.embedding), 6) AS dot
FROM rated r JOIN prof p USING (userId)"""),
    "user_profiles": sql("""SELECT userId, CAST(pos AS BIGINT) AS pos,
       round(CASE WHEN tw > 0 THEN s / tw ELSE s END, 6) AS value FROM psum JOIN pw USING (userId)"""),
    # ranker inputs
    "candidate_minmax": sql(f"SELECT userId, itemId, {r6('alsScore')} FROM mm"),
    "candidate_features": sql(f"""SELECT userId, itemId, {r6('alsScore')}, {r6('w2vScore')}, {r6('logItemPop')},
       {r6('logUserActivity')}, {r6('itemAvgRating')}, userRatingCount, itemRatingCount, itemReviewCount
FROM feats"""),
    "label_candidates": sql(f"""SELECT userId, itemId, {r6('alsScore')}, {r6('w2vScore')}, {r6('logItemPop')},
       {r6('logUserActivity')}, {r6('itemAvgRating')}, userRatingCount, itemRatingCount, itemReviewCount,
       label FROM labeled"""),
    "positive_rate": sql("""SELECT positives, negatives,
       round(COALESCE(CAST(positives AS DOUBLE) * 100.0 / NULLIF(positives + negatives, 0), 0.0), 6)
         AS positiveRate FROM lc"""),
    "balanced_training_set": sql(f"""SELECT userId, itemId, label,
       CASE WHEN label = 1.0 THEN CAST(3.0 AS DOUBLE) ELSE CAST(1.0 AS DOUBLE) END AS classWeight,
       {r6('alsScore')}, {r6('w2vScore')}, {r6('logItemPop')}, {r6('logUserActivity')}, {r6('itemAvgRating')},
       CASE WHEN {hb(PAIR, 43, 100)} < 80 THEN 'train' ELSE 'test' END AS split
FROM labeled, (SELECT CASE WHEN negatives <= 0 THEN 1000000
                      ELSE CAST(round(LEAST(1.0, CAST(positives * 10 AS DOUBLE) / CAST(negatives AS DOUBLE))
                                      * 1000000) AS BIGINT) END AS t FROM lc) th
WHERE label = 1.0 OR (label = 0.0 AND {hb(PAIR, 42, 1000000)} < t)"""),
    "accuracy_report": sql("""SELECT count(*) AS n,
       round(avg(CASE WHEN (CASE WHEN alsScore >= 0.5 THEN 1.0 ELSE 0.0 END) = label THEN 1 ELSE 0 END), 6)
         AS accuracy FROM labeled"""),
    "rmse_report": sql("""SELECT n, round(rmse, 6) AS rmse,
       CASE WHEN rmse < 0.8 THEN 'Excellent' WHEN rmse < 1.2 THEN 'Good'
            ELSE 'Acceptable - consider tuning' END AS quality
FROM (SELECT count(*) AS n,
             sqrt(avg((CAST(rating AS DOUBLE) - CAST(prediction AS DOUBLE))
                      * (CAST(rating AS DOUBLE) - CAST(prediction AS DOUBLE)))) AS rmse
      FROM predictions WHERE prediction IS NOT NULL AND NOT isnan(prediction)) t"""),
    # sampling and segments
    "sample_users": sql("SELECT * FROM samp"),
    "segment_users": sql("SELECT * FROM seg"),
    "segment_users_sampled": sql("SELECT * FROM seg WHERE userId IN (SELECT userId FROM samp)"),
    "users_without_recs": sql("SELECT count(*) AS users, CAST(0 AS BIGINT) AS without FROM act"),
    "train_test_split": sql(f"""SELECT userId, itemId, rating,
       CASE WHEN {hb('userId', 42, 10000)} < 8000 THEN 'train' ELSE 'test' END AS split FROM active"""),
    # recommendation paths
    "recommend_cold": sql("SELECT * FROM cold_recs"),
    "candidate_pool": sql(f"SELECT itemId, {r6('itemAvgRating')}, itemRatingCount, {r6('logItemPop')} FROM pool"),
    "users_without_profile": sql("SELECT * FROM nop"),
    "recommend_fallback": sql("SELECT * FROM fb_recs"),
    "recommend_ties": sql("""SELECT * FROM (SELECT userId, itemId, CAST(rating AS DOUBLE) AS score,
       CAST(rank() OVER (PARTITION BY userId ORDER BY CAST(rating AS DOUBLE) DESC) AS INT) AS rank
FROM ratings) t WHERE rank <= 10"""),
    "combine_paths": sql(f"""SELECT userId, itemId, {r6('hybridScore')}, {r6('alsScore')}, {r6('w2vScore')}, source, rank
FROM (SELECT * FROM warm_sb WHERE rank <= 10 UNION ALL SELECT * FROM cold_recs UNION ALL SELECT * FROM fb_recs) u"""),
    # reports
    "source_breakdown": sql("""SELECT source, count(*) AS totalRecs, count(DISTINCT userId) AS usersServed
FROM recs GROUP BY source"""),
    "coverage_report": sql("""SELECT totalRecs, usersWithRecs, sampledUsers, totalUsers,
       round(COALESCE(CAST(usersWithRecs AS DOUBLE) * 100.0 / NULLIF(sampledUsers, 0), 0.0), 6) AS coverageSampledPct,
       round(COALESCE(CAST(usersWithRecs AS DOUBLE) * 100.0 / NULLIF(totalUsers, 0), 0.0), 6) AS coverageAllPct
FROM (SELECT count(*) AS totalRecs, count(DISTINCT userId) AS usersWithRecs FROM recs) a,
     (SELECT count(DISTINCT userId) AS sampledUsers FROM seg) b,
     (SELECT count(DISTINCT userId) AS totalUsers FROM ratings) c"""),
    "personalization": sql("""SELECT uniqueTopItems, usersWithRecs,
       round(COALESCE(CAST(uniqueTopItems AS DOUBLE) * 100.0 / NULLIF(usersWithRecs, 0), 0.0), 6)
         AS personalizationPct
FROM (SELECT count(DISTINCT CASE WHEN rank = 1 THEN itemId END) AS uniqueTopItems,
             count(DISTINCT userId) AS usersWithRecs FROM recs) t"""),
    "rec_preview": sql(f"""SELECT userId, itemId, {r6('hybridScore')}, {r6('alsScore')}, {r6('w2vScore')}, source, rank
FROM recs WHERE source = 'w2v_personalized' AND rank <= 3 ORDER BY userId, rank, itemId LIMIT 15"""),
    "dataset_stats": sql("""SELECT totalUsers, totalItems, totalRatings, usersWithRecs,
       round(round(COALESCE(CAST(usersWithRecs AS DOUBLE) * 100.0 / NULLIF(totalUsers, 0), 0.0), 2), 6)
         AS coveragePct, coldUsers, warmUsers, powerUsers
FROM (SELECT count(*) AS totalRatings, count(DISTINCT userId) AS totalUsers,
             count(DISTINCT itemId) AS totalItems FROM ratings) r,
     (SELECT count(*) FILTER (WHERE userRatingCount <= 5) AS coldUsers,
             count(*) FILTER (WHERE userRatingCount > 5) AS warmUsers,
             count(*) FILTER (WHERE userRatingCount > 20) AS powerUsers FROM act) a,
     (SELECT count(DISTINCT userId) AS usersWithRecs FROM recs) s"""),
    "segment_share": sql(f"""SELECT segment, users,
       round(round(CAST(users AS DOUBLE) * 100.0 / sum(users) OVER (), 1), 6) AS sharePct
FROM (SELECT {SEGMENT.format('userRatingCount')} AS segment, count(*) AS users FROM act GROUP BY 1) t"""),
    "enrich_recs": sql(f"""SELECT userId, rank, itemId, asin, {r6('hybridScore')}, {r6('alsScore')},
       {r6('w2vScore')}, source, {r6('avgRating')}, reviewCount, amazonUrl FROM enr"""),
    "enrich_recs_no_meta": sql(f"""SELECT r.userId, r.rank, r.itemId,
       COALESCE(x.asin, 'UNKNOWN_' || CAST(r.itemId AS VARCHAR)) AS asin,
       round(round(r.hybridScore, 4), 6) AS hybridScore, round(round(r.alsScore, 4), 6) AS alsScore,
       round(round(r.w2vScore, 4), 6) AS w2vScore, r.source,
       CAST(0.0 AS DOUBLE) AS avgRating, CAST(0 AS BIGINT) AS reviewCount,
       'https://www.amazon.com/dp/' || COALESCE(x.asin, 'UNKNOWN_' || CAST(r.itemId AS VARCHAR)) AS amazonUrl
FROM recs r LEFT JOIN iidx x ON CAST(x.itemIndex AS INT) = r.itemId"""),
    "lookup_recs": sql(f"""SELECT q.userId, q.topN, e.itemId IS NOT NULL AS found,
       a.userRatingCount IS NOT NULL AS userExists,
       CAST(CASE WHEN e.itemId IS NOT NULL THEN COALESCE(a.userRatingCount, 0) END AS DOUBLE) AS ratingCount,
       CASE WHEN e.itemId IS NOT NULL THEN {SEGMENT.format('COALESCE(a.userRatingCount, 0)')} END AS segment,
       CASE WHEN e.itemId IS NOT NULL THEN f.userSource END AS source,
       CASE WHEN e.itemId IS NULL THEN 'No recommendations found for this user.' END AS message,
       CAST(e.rank AS DOUBLE) AS rank, CAST(e.itemId AS DOUBLE) AS itemId, e.asin,
       {r6('e.hybridScore')}, {r6('e.alsScore')}, {r6('e.w2vScore')},
       {r6('e.avgRating')}, CAST(e.reviewCount AS DOUBLE) AS reviewCount, e.amazonUrl
FROM (SELECT CAST(c_custkey AS INT) AS userId,
             LEAST(GREATEST(COALESCE(CAST(c_custkey % 12 AS INT), 10), 1), 10) AS topN FROM customer) q
LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY userId ORDER BY rank, itemId) AS pos FROM enr) e
  ON e.userId = q.userId AND e.pos <= q.topN
LEFT JOIN (SELECT userId, source AS userSource FROM
            (SELECT *, row_number() OVER (PARTITION BY userId ORDER BY rank, itemId) AS pos FROM enr) z
           WHERE pos = 1) f ON f.userId = q.userId
LEFT JOIN act a ON a.userId = q.userId"""),
    "path_coverage": sql("""SELECT 'w2v_personalized' AS source,
       (SELECT count(DISTINCT userId) FROM recs WHERE source = 'w2v_personalized'
        AND userId IN (SELECT userId FROM cold)) AS usersServed,
       (SELECT count(DISTINCT userId) FROM cold) AS usersTargeted"""),
    "sample_users_by_segment": sql(f"""SELECT segment, userId, userRatingCount FROM (
  SELECT *, row_number() OVER (PARTITION BY segment ORDER BY {md5key('userId')}, userId) AS rn FROM (
    SELECT DISTINCT r.userId, a.userRatingCount, {SEGMENT.format('a.userRatingCount')} AS segment
    FROM recs r JOIN act a USING (userId)) u) t WHERE rn <= 5"""),
}
ORACLE["active_ratings_bucketed"] = ORACLE["active_ratings"]
ORACLE["lookup_stream"] = ORACLE["lookup_served"] = ORACLE["lookup_recs"]

# Exact areas: rank sums with ties counted half, and straight lines between the points (recall,
# precision) of the distinct scores.
ORACLE["auc_exact"] = sql("""SELECT CAST(p + q AS BIGINT) AS n, CAST(p AS BIGINT) AS positives,
       round(roc / (p * q), 6) AS aucROC, round(area / p, 6) AS aucPR
FROM (SELECT sum(pos) AS p, sum(neg) AS q, sum(neg * (tp - pos + pos / 2.0::DOUBLE)) AS roc,
             sum(pos * (tp / (tp + fp) + CASE WHEN tp - pos + fp - neg = 0 THEN tp / (tp + fp)
                                             ELSE (tp - pos) / (tp - pos + fp - neg) END) / 2) AS area
      FROM (SELECT *, CAST(sum(pos) OVER w AS DOUBLE) AS tp, CAST(sum(neg) OVER w AS DOUBLE) AS fp
            FROM (SELECT round(alsScore, 2) AS score, count(*) FILTER (WHERE label > 0.5) AS pos,
                         count(*) FILTER (WHERE label <= 0.5) AS neg FROM labeled GROUP BY 1)
            WINDOW w AS (ORDER BY score DESC)))""")
ORACLE["nearest_vectors"] = sql(f"""
SELECT query, id, similarity, CAST(rank AS INT) AS rank FROM (
  SELECT query, id, similarity, row_number() OVER (PARTITION BY query ORDER BY similarity DESC, id) AS rank
  FROM (SELECT q.vec_id AS query, v.vec_id AS id, round(list_dot_product(qv, vv)
               / ({NORM.format('qv')} * {NORM.format('vv')}), 6) AS similarity
        FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS qv FROM embeddings WHERE vec_id % 100 = 0) q
        JOIN (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS vv FROM embeddings) v ON q.vec_id <> v.vec_id))
WHERE rank <= 10""")
ORACLE["cooccurrences"] = sql("""SELECT least(p[1], p[2]) AS first, greatest(p[1], p[2]) AS second, count(*) AS n
FROM (SELECT unnest(list_transform(range(1, len(tk) - gap + 1), lambda i: [tk[i], tk[i + gap]])) AS p
      FROM ptok, (SELECT unnest([1, 2]) AS gap))
WHERE p[1] <> p[2] GROUP BY ALL HAVING count(*) >= 50""")
ORACLE["als_hot_items"] = sql("SELECT DISTINCT itemId, true AS solved FROM ratings")

# Fitted models: what the data determine of them.
ORACLE |= {
    "als_predictions": sql("""SELECT userId, itemId, rating, true AS finite FROM mside WHERE NOT train
AND userId IN (SELECT userId FROM mtrain) AND itemId IN (SELECT itemId FROM mtrain)"""),
    "als_user_topk": sql("""SELECT DISTINCT userId,
       least(5, (SELECT count(DISTINCT itemId) FROM mtrain)) AS n FROM mtrain"""),
    "als_item_topk": sql("""SELECT DISTINCT itemId,
       least(5, (SELECT count(DISTINCT userId) FROM mtrain)) AS n FROM mtrain"""),
    "als_candidates": sql("""SELECT userId, least(50, (SELECT count(DISTINCT itemId) FROM mtrain)) AS n
FROM mact WHERE n >= 6 AND userId IN (SELECT userId FROM mtrain)"""),
    "als_item_factors": sql("SELECT DISTINCT itemId, CAST(15 AS BIGINT) AS rank FROM mtrain"),
    "w2v_item_embeddings": sql(f"""SELECT CAST(itemIndex AS INT) AS itemId, {r6('avgRating', 'itemAvgRating')},
       reviewCount AS itemReviewCount, CAST(50 AS BIGINT) AS dim, true AS finite
FROM embi JOIN iidx USING (asin)"""),
    "w2v_synonyms": sql("""SELECT word AS query, CAST(5 AS BIGINT) AS n FROM vocab
WHERE word <> '' ORDER BY word LIMIT 3"""),
    "fit_or_load": sql("SELECT word, CAST(50 AS BIGINT) AS dim FROM vocab"),
    "gbt_report": "SELECT true AS tested, true AS aucROC, true AS aucPR, true AS accuracy",
    "gbt_importances": "SELECT unnest(['alsScore', 'w2vScore', 'logItemPop', 'logUserActivity', "
                       "'itemAvgRating']) AS feature, true AS valid",
    "recommend_warm": sql("""SELECT userId, CAST(10 AS BIGINT) AS n, CAST(10 AS BIGINT) AS lastRank
FROM mact WHERE n >= 6 AND userId IN (SELECT userId FROM mtrain)"""),
    "recommend_all": sql("SELECT userId, CAST(1 AS BIGINT) AS sources, true AS ranked FROM mact"),
    "model_report": sql("""SELECT count(*) AS nRated, true AS rmse, true AS aucROC,
       'alsScore,itemAvgRating,logItemPop,logUserActivity,w2vScore' AS features,
       CAST(1.0 AS DOUBLE) AS importance
FROM mside WHERE NOT train AND userId IN (SELECT userId FROM mtrain) AND itemId IN (SELECT itemId FROM mtrain)"""),
}
ORACLE["split_by_time"] = sql("""SELECT CASE WHEN t <= cut THEN 'train' ELSE 'test' END AS split, count(*) AS n,
       min(t) AS lo, max(t) AS hi
FROM (SELECT r.timestamp AS t, (SELECT quantile_disc(timestamp, 0.8) FROM ratings
        WHERE userId IN (SELECT userId FROM active)) AS cut
      FROM ratings r WHERE userId IN (SELECT userId FROM active)) q GROUP BY 1""")
