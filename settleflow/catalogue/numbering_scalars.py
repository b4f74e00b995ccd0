"""Window functions, numbering and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from settleflow.catalogue.base import query
from settleflow.functions import scalars as S
from settleflow.operators.aggregates import latest_per_key
from settleflow.operators.joins import positional_pair
from settleflow.operators.numbering import batch_number, global_dense_rank, global_row_number, join_null_safe, keyed_row_number, round_number
from settleflow.operators.packing import next_fit
from settleflow.operators.paging import page


@query("win_total_count", "transfer_code:s amount:d total_count:i",
       "SELECT transfer_code, amount, count(*) OVER () AS total_count FROM r_transfer ORDER BY created_at, transfer_id LIMIT 10")
def _(r):
    return page(r.transfer, [F.col("created_at").asc_nulls_first(), F.col("transfer_id")])


@query("win_partition_counts", "transfer_id:i subgroup_id:i subgroups:i paid:i mailed:i",
       """SELECT transfer_id, subgroup_id, count(subgroup_id) OVER (PARTITION BY transfer_id) AS subgroups,
          count(CASE WHEN is_paid=1 THEN 1 END) OVER (PARTITION BY transfer_id) AS paid,
          count(CASE WHEN is_mailed=1 THEN 1 END) OVER (PARTITION BY transfer_id) AS mailed
          FROM (SELECT DISTINCT d.transfer_id, s.subgroup_id, s.is_paid, s.is_mailed FROM r_subgroup_detail d JOIN r_subgroup s ON d.subgroup_id=s.subgroup_id)""")
def _(r):
    pairs = r.subgroup_detail.select("transfer_id", "subgroup_id").distinct().join(r.subgroup, "subgroup_id")
    # counts by aggregation and a join back, so that a large transfer is never one window partition
    counts = pairs.groupBy("transfer_id").agg(
        F.count("subgroup_id").alias("subgroups"), F.sum("is_paid").alias("paid"), F.sum("is_mailed").alias("mailed"))
    return join_null_safe(pairs.select("transfer_id", "subgroup_id"), counts, ["transfer_id"])


LOG_ORDER = "created_at DESC NULLS LAST, tie1, tie2, tie3, tie4"


@query("win_latest_per_key", "detail_id:i cover_amount:d is_manual_npl:i created_at:t",
       f"""SELECT detail_id, cover_amount, is_manual_npl, created_at FROM (SELECT *, row_number() OVER (PARTITION BY detail_id ORDER BY {LOG_ORDER}) AS rn
          FROM r_cover_log) WHERE rn=1""")
def _(r):
    newest = [F.col("created_at").desc_nulls_last(), *[F.col(f"tie{i}") for i in (1, 2, 3, 4)]]
    return latest_per_key(r.cover_log, ["detail_id"], newest)


@query("win_dedupe_composite", "customer_id:i insurer_id:i claim_type_code:s group_type:i group_code:s",
       """SELECT customer_id, insurer_id, claim_type_code, group_type, group_code FROM (SELECT *, row_number() OVER
          (PARTITION BY customer_id, insurer_id, claim_type_code, group_type ORDER BY created_at DESC, order_key DESC) AS rn FROM r_group) WHERE rn=1""")
def _(r):
    keys = ["customer_id", "insurer_id", "claim_type_code", "group_type"]
    return latest_per_key(r.group, keys, [F.col("created_at").desc(), F.col("order_key").desc()])


@query("global_row_number", "claim_code:s row_no:i", "SELECT claim_code, row_number() OVER (ORDER BY amount, claim_code) AS row_no FROM r_item")
def _(r):
    return global_row_number(r.item.select("claim_code", "amount"), ["amount", "claim_code"])


@query("global_dense_rank", "group_code:s created_at:t rank_no:i",
       "SELECT group_code, created_at, dense_rank() OVER (ORDER BY created_at) AS rank_no FROM r_group")
def _(r):
    return global_dense_rank(r.group.select("group_code", "created_at"), ["created_at"])


@query("keyed_row_number", "insurer_id:i claim_code:s row_no:i",
       "SELECT insurer_id, claim_code, row_number() OVER (PARTITION BY insurer_id ORDER BY claim_code) AS row_no FROM r_import_detail")
def _(r):
    return keyed_row_number(r.import_detail.select("insurer_id", "claim_code"), ["insurer_id"], ["claim_code"])


@query("positional_pair", "claim_code:s group_code:s",
       """SELECT claim_code, group_code FROM (SELECT claim_code, row_number() OVER (ORDER BY claim_code) AS n FROM r_item) a
          JOIN (SELECT group_code, row_number() OVER (ORDER BY order_key DESC) AS n FROM r_group) b ON a.n=b.n""")
def _(r):
    return positional_pair(r.item.select("claim_code"), r.group.select("group_code", (-F.col("order_key")).alias("k")), ["claim_code"], ["k"])


@query("batch_fixed_size", "insurer_id:i batch_no:i items:i amount:d",
       """SELECT insurer_id, batch_no, count(*) AS items, sum(pay_total) AS amount FROM (SELECT insurer_id, pay_total,
          (row_number() OVER (PARTITION BY insurer_id ORDER BY claim_code) - 1) // 20 AS batch_no FROM r_import_detail) GROUP BY insurer_id, batch_no""")
def _(r):
    numbered = keyed_row_number(r.import_detail.select("insurer_id", "claim_code", "pay_total"), ["insurer_id"], ["claim_code"])
    return (numbered.withColumn("batch_no", batch_number(F.col("row_no"), 20)).groupBy("insurer_id", "batch_no")
            .agg(F.count(F.lit(1)).alias("items"), F.sum("pay_total").alias("amount")))


@query("batch_amount_ceiling", "transfer_id:i payback_id:i amount:d group_no:i",
       """s AS (SELECT transfer_id, payback_id, amount, row_number() OVER (PARTITION BY transfer_id ORDER BY payback_id) AS n FROM r_payback WHERE transfer_id IS NOT NULL),
       walk AS (SELECT transfer_id, payback_id, amount, n, CAST(CASE WHEN amount > 1000000 THEN 2 ELSE 1 END AS BIGINT) AS group_no, CAST(amount AS DECIMAL(18,2)) AS total FROM s WHERE n=1
         UNION ALL SELECT s.transfer_id, s.payback_id, s.amount, s.n, CASE WHEN w.total+s.amount > 1000000 THEN w.group_no+1 ELSE w.group_no END,
         CAST(CASE WHEN w.total+s.amount > 1000000 THEN s.amount ELSE w.total+s.amount END AS DECIMAL(18,2)) FROM walk w JOIN s ON s.transfer_id=w.transfer_id AND s.n=w.n+1)
       ;; SELECT transfer_id, payback_id, amount, group_no FROM walk""")
def _(r):
    rows = r.payback.filter("transfer_id IS NOT NULL").select("transfer_id", "payback_id", "amount")
    return next_fit(rows, "transfer_id", ["payback_id"], F.col("amount"), 1000000)


@query("round_robin_continue", "claim_code:s round_no:i",
       """SELECT claim_code, ((SELECT count(*) FROM r_reject) + row_number() OVER (ORDER BY claim_code) - 1) % 5 + 1 AS round_no FROM r_item""")
def _(r):
    last = r.reject.agg(F.count(F.lit(1)).alias("n")).scalar()
    numbered = global_row_number(r.item.select("claim_code"), ["claim_code"])
    return numbered.withColumn("last", last).withColumn("round_no", round_number(F.col("row_no"), F.col("last")))


@query("fn_conditional", "order_key:i first_type:s reduced:i label:s size:s",
       """SELECT order_key, substr(coalesce(CASE WHEN status_id=3 THEN claim_type_code END, 'none given'), 1, 4) AS first_type, nullif(group_type, 4) AS reduced,
          CASE WHEN status_id=2 THEN 'waiting' ELSE 'other' END AS label,
          CASE WHEN order_total >= 200000 THEN 'large' WHEN order_total >= 50000 THEN 'medium' ELSE 'small' END AS size FROM r_group""")
def _(r):
    total = F.col("order_total")
    first = F.when(F.col("status_id") == 3, F.col("claim_type_code"))
    return r.group.select(
        "order_key", S.if_null(first, "none given", "varchar(4)").substr(1, 4).alias("first_type"),
        F.nullif("group_type", F.lit(4)).alias("reduced"),
        F.when(F.col("status_id") == 2, "waiting").otherwise("other").alias("label"),
        F.when(total >= 200000, "large").when(total >= 50000, "medium").otherwise("small").alias("size"))


@query("fn_concat_null", "claim_code:s tolerant:s strict:s",
       """SELECT claim_code, concat(CASE WHEN rf='R' THEN 'R' END, '/', ls) AS tolerant, CASE WHEN rf='R' THEN 'R' END || '/' || ls AS strict FROM r_item""")
def _(r):
    maybe = F.when(F.col("rf") == "R", F.lit("R"))
    return r.item.select("claim_code", S.join_text(maybe, F.lit("/"), F.col("ls")).alias("tolerant"), F.concat(maybe, F.lit("/"), F.col("ls")).alias("strict"))


@query("fn_substr_replace", "group_code:s head:s tail:s fourth:s dotted:s",
       """SELECT group_code, left(group_code,3) AS head, right(group_code,1) AS tail, right(left(group_code,4),1) AS fourth, replace(group_code,'-','.') AS dotted FROM r_group""")
def _(r):
    code = F.col("group_code")
    return r.group.select("group_code", F.left(code, F.lit(3)).alias("head"), F.right(code, F.lit(1)).alias("tail"),
                          F.right(F.left(code, F.lit(4)), F.lit(1)).alias("fourth"), F.replace(code, F.lit("-"), F.lit(".")).alias("dotted"))


@query("fn_parse_code", "group_code:s p1:s p2:i p3:i p4:i",
       """SELECT group_code, split_part(group_code,'-',1) AS p1, TRY_CAST(split_part(group_code,'-',2) AS INT) AS p2,
          TRY_CAST(split_part(group_code,'-',3) AS INT) AS p3, TRY_CAST(split_part(group_code,'-',4) AS INT) AS p4 FROM r_group""")
def _(r):
    code = F.col("group_code")
    return r.group.select("group_code", S.code_part(code, 4).alias("p1"), *[S.code_part_int(code, n).alias(f"p{5 - n}") for n in (3, 2, 1)])


@query("fn_zero_pad", "order_key:i narrow:s wide:s", "SELECT order_key, printf('%03d', order_key) AS narrow, printf('%012d', order_key) AS wide FROM r_group")
def _(r):
    key = F.col("order_key")
    return r.group.select("order_key", S.zero_pad(key, 3).alias("narrow"), S.zero_pad(key, 12).alias("wide"))


@query("fn_format", "order_key:i money_text:s month_text:s stamp:s",
       """SELECT order_key, format('{:,.2f}', CAST(order_total AS DOUBLE)) AS money_text, strftime(created_at,'%Y-%m-01') AS month_text,
          strftime(created_at,'%d %m %Y %H:%M') AS stamp FROM r_group""")
def _(r):
    return r.group.select("order_key", F.format_number("order_total", 2).alias("money_text"),
                          F.date_format(S.month_start(F.col("created_at")), "yyyy-MM-dd").alias("month_text"),
                          F.date_format("created_at", "dd MM yyyy HH:mm").alias("stamp"))


@query("fn_base64_link", "claim_code:s link:s", "SELECT claim_code, 'claim?id=' || base64(CAST(claim_code AS BLOB)) AS link FROM r_item")
def _(r):
    return r.item.select("claim_code", F.concat(F.lit("claim?id="), S.link_token(F.col("claim_code"))).alias("link"))


@query("fn_due_date", "order_key:i due:y due_working:y",
       """SELECT order_key, d + CAST(19 + CASE WHEN dayofweek(d)+1+4 >= 7 THEN 1 ELSE 0 END AS INT) AS due,
          CAST((SELECT max(x) FROM (SELECT unnest(generate_series(d, d + INTERVAL 21 DAY, INTERVAL 1 DAY)) AS x) WHERE
            (SELECT count(*) FROM (SELECT unnest(generate_series(d + INTERVAL 1 DAY, x, INTERVAL 1 DAY)) AS y) WHERE dayofweek(y) NOT IN (0,6)) = 15
            AND dayofweek(x) NOT IN (0,6)) AS DATE) AS due_working
          FROM (SELECT order_key, CAST(created_at AS DATE) AS d FROM r_group)""")
def _(r):
    day = F.col("created_at")
    return r.group.select("order_key", S.due_date(day).alias("due"), S.due_date(day, working_days=True).alias("due_working"))


@query("fn_be_year", "order_key:i yy:s", "SELECT order_key, printf('%02d', (year(created_at)+543)%100) AS yy FROM r_group")
def _(r):
    return r.group.select("order_key", S.buddhist_year2(F.col("created_at")).alias("yy"))


@query("fn_dates", "event_id:i next_day:y yr:i mon:i midnight:i",
       """SELECT event_id, CAST(ts AS DATE)+1 AS next_day, year(ts) AS yr, month(ts) AS mon,
          CASE WHEN strftime(ts,'%H:%M:%S')='00:00:00' THEN 1 ELSE 0 END AS midnight FROM events""")
def _(r):
    ts = F.col("ts")
    return r.t("events").select("event_id", F.date_add(F.to_date(ts), 1).alias("next_day"), F.year(ts).alias("yr"), F.month(ts).alias("mon"),
                                S.flag(S.is_midnight(ts)).alias("midnight"))


@query("fn_cast", "event_id:i amount:d whole:i bad:i day:y",
       """SELECT event_id, CAST(value AS DECIMAL(16,2)) AS amount, TRY_CAST(CAST(user_id AS VARCHAR) AS INT) AS whole, TRY_CAST(event_type AS INT) AS bad,
          CAST(ts AS DATE) AS day FROM events""")
def _(r):
    return r.t("events").select("event_id", S.money(F.col("value")).alias("amount"), F.col("user_id").cast("string").try_cast("int").alias("whole"),
                                F.col("event_type").try_cast("int").alias("bad"), F.col("ts").cast("date").alias("day"))


@query("fn_message_accumulate", "group_code:s warning:s is_valid:i",
       """SELECT group_code, warning, CASE WHEN warning='' THEN 1 ELSE 0 END AS is_valid FROM (SELECT group_code,
          concat_ws(', ', CASE WHEN total_amount=0 THEN 'no amount' END, CASE WHEN item_count=0 THEN 'no claims' END,
          CASE WHEN insurer_id=1 THEN 'own company' END) AS warning FROM r_imported)""")
def _(r):
    out = r.imported.select("group_code", S.messages(
        (F.col("total_amount") == 0, "no amount"), (F.col("item_count") == 0, "no claims"), (F.col("insurer_id") == 1, "own company")).alias("warning"))
    return out.withColumn("is_valid", S.flag(F.col("warning") == ""))
