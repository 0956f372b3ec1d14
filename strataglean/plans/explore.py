"""Sources, sinks, predicates, aggregates and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from strataglean.functions.hashing import BLOOM_HASHES, mod_hash, trailing_zeros
from strataglean.functions.text import AMBIENCE
from strataglean.operators import recommend, relational
from strataglean.session import scratch_path
from strataglean.skew import dense_number, spread_scan
from strataglean.sources import files, roles

YEAR = 2000

REVIEWS = """reviews as (
  select o_custkey user_id, l_suppkey item_id, (1 + l_quantity::int % 5)::int stars, o_orderdate "day"
  from lineitem join orders on l_orderkey = o_orderkey)"""


def scan_json(spark, sf):
    events = roles.table(spark, sf, "events").select("event_id", "user_id", "event_type", "value", "props")
    path = scratch_path(spark, "events-json")
    files.write_json(events, path)
    schema = "event_id bigint, user_id bigint, event_type string, value double, props string"
    return files.read_json_lines(spark, path, schema).select(
        "event_id", "user_id", "event_type", "value",
        F.from_json("props", "k int")["k"].alias("k"))


def scan_csv(spark, sf):
    path = scratch_path(spark, "customer-csv")
    files.write_csv(roles.table(spark, sf, "customer"), path)
    return files.read_csv(
        spark, path,
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string")


def parse_vectors(spark, sf):
    vectors = roles.vectors(spark, sf)
    lines = vectors.select(F.concat_ws(
        ",", F.col("id").cast("string"), F.col("label").cast("string"),
        F.array_join(F.transform("features", lambda v: v.cast("string")), ",")).alias("value"))
    parsed = files.parse_vectors(lines)
    return parsed.select("id", "label", F.posexplode("features").alias("dim", "v")).select(
        "id", "label", F.col("dim").cast("bigint").alias("dim"), F.round("v", 6).alias("value"))


def basket_preprocess(spark, sf):
    """Transactions as text (date, padded customer, zero-led product) -> basket key and product."""
    lines = roles.table(spark, sf, "lineitem").select("l_orderkey", "l_partkey")
    orders = roles.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    raw = lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.date_format("o_orderdate", "M/d/yyyy").alias("date"),
        F.concat(F.col("o_custkey").cast("string"), F.lit(" ")).alias("customer"),
        F.lpad(F.col("l_partkey").cast("string"), 8, "0").alias("product"))
    return files.transaction_baskets(raw)


def city_avg_stars(spark, sf):
    means = relational.group_mean_by_lookup(
        roles.reviews(spark, sf), roles.businesses(spark, sf), "item_id", "city", "stars")
    return means.select("city", F.round("mean", 6).alias("stars"))


def sink_roundtrip_csv(spark, sf):
    path = scratch_path(spark, "city-csv")
    files.write_csv(city_avg_stars(spark, sf), path)
    return files.read_csv(spark, path, "city string, stars double")


def overview_metrics(spark, sf):
    m = relational.overview_metrics(roles.reviews(spark, sf), YEAR)
    return m.withColumn("avg_stars", F.round("avg_stars", 6))


def metrics_json(spark, sf):
    reviews = roles.reviews(spark, sf)
    return relational.metrics_json(
        overview_metrics(spark, sf),
        {"top10_user": relational.top_k(reviews, "user_id"),
         "top10_business": relational.top_k(reviews, "item_id")})


def partition_profile(spark, sf):
    return relational.partition_profile(roles.reviews(spark, sf), "item_id", 8)


def text_partitions(spark, sf):
    """Review lines as text, read back over at least eight partitions: lines, distinct lines, partitions."""
    path = scratch_path(spark, "lines")
    pairs = roles.reviews(spark, sf).select(F.concat_ws(",", "user_id", "item_id").alias("value"))
    files.write_lines(pairs, "value", path)
    lines = files.read_text(spark, path, 8)
    return lines.select("value", F.spark_partition_id().alias("partition")).agg(
        F.count(F.lit(1)).alias("n_items"), F.countDistinct("value").alias("n_lines"),
        (F.countDistinct("partition") >= 8).alias("spread"))


def count_in_year(spark, sf):
    reviews = roles.reviews(spark, sf)
    by_text = relational.count_containing(reviews, F.col("day"), str(YEAR)).withColumnRenamed("n", "n_text")
    by_year = reviews.agg(F.count_if(F.year("day") == YEAR).alias("n_year"))
    return by_text.crossJoin(F.broadcast(by_year))  # one row each


def having_min_size(spark, sf):
    return relational.having_min_size(roles.reviews(spark, sf), "user_id", "item_id", 30)


def prefix_filter(spark, sf):
    keys = roles.table(spark, sf, "lineitem").select(F.col("l_partkey").cast("string").alias("item"))
    return keys.filter(~F.col("item").startswith("1")).groupBy("item").agg(F.count(F.lit(1)).alias("n"))


def user_item_averages(spark, sf):
    reviews = roles.reviews(spark, sf)

    def one(kind, key):
        return recommend.averages(reviews, key).select(
            F.lit(kind).alias("kind"), F.col(key).alias("id"), F.round("avg_stars", 6).alias("avg_stars"), "n")

    return one("user", "user_id").unionByName(one("item", "item_id"))


def distinct_pairs(spark, sf):
    return roles.reviews(spark, sf).select("user_id", "item_id").distinct()


def interaction_zscore(spark, sf):
    train = roles.train_reviews(spark, sf)
    users, items = recommend.user_table(train), recommend.item_table(train)
    stats = recommend.interaction_stats(train, users, items)
    pairs = train.select("user_id", "item_id").distinct()
    return recommend.rating_features(pairs, users, items).crossJoin(F.broadcast(stats)).select(
        "user_id", "item_id",
        F.round(recommend.z_score(F.col("average_stars") * F.col("stars"), F.col("mean"), F.col("sd")), 6).alias("z"))


def dense_index(spark, sf):
    ids = roles.table(spark, sf, "lineitem").select(F.col("l_partkey").cast("string").alias("id")).distinct()
    return dense_number(ids, ["id"], "index", start=0).select("id", F.col("index").cast("bigint").alias("index"))


def split_sample(spark, sf):
    return files.split_sample(roles.table(spark, sf, "customer").select("c_custkey"), "c_custkey", 20)


def sentiment_counts(spark, sf):
    texts = spread_scan(roles.table(spark, sf, "documents").select("doc_id", "text"))
    return recommend.sentiment_counts(texts, "text").drop("text")


def string_mod_hash(spark, sf):
    ids = roles.table(spark, sf, "customer").select(F.col("c_name").alias("id"))
    return ids.select("id", *[
        mod_hash(F.col("id"), a, b, m, p).alias(f"h{i}") for i, (a, b, p, m) in enumerate(BLOOM_HASHES)])


def trailing_zero_bits(spark, sf):
    return roles.table(spark, sf, "orders").select(
        "o_orderkey", trailing_zeros(F.col("o_orderkey")).cast("bigint").alias("zeros"))


def business_features(spark, sf):
    return recommend.business_features(roles.business_records(spark, sf))


def count_by_key(spark, sf):
    return relational.count_by_key(roles.reviews(spark, sf), "item_id")


def top_users(spark, sf):
    return relational.top_k(roles.reviews(spark, sf), "user_id")


def top_businesses(spark, sf):
    return relational.top_k(roles.reviews(spark, sf), "item_id")


def latest_rating(spark, sf):
    return recommend.latest_ratings(roles.reviews(spark, sf))


QUERIES = {
    "scan_json": scan_json, "scan_csv": scan_csv, "parse_vectors": parse_vectors,
    "basket_preprocess": basket_preprocess, "sink_roundtrip_csv": sink_roundtrip_csv,
    "metrics_json": metrics_json, "partition_profile": partition_profile,
    "text_partitions": text_partitions, "count_in_year": count_in_year,
    "having_min_size": having_min_size, "prefix_filter": prefix_filter,
    "city_avg_stars": city_avg_stars, "overview_metrics": overview_metrics,
    "count_by_key": count_by_key, "top_users": top_users, "top_businesses": top_businesses,
    "user_item_averages": user_item_averages, "distinct_pairs": distinct_pairs,
    "latest_rating": latest_rating, "interaction_zscore": interaction_zscore,
    "dense_index": dense_index, "split_sample": split_sample,
    "sentiment_counts": sentiment_counts, "string_mod_hash": string_mod_hash,
    "trailing_zeros": trailing_zero_bits, "business_features": business_features,
}

_CITY = f"""with {REVIEWS}
select n_name city, round(sum(stars) / count(*), 6) stars
from reviews join supplier on item_id = s_suppkey join nation on s_nationkey = n_nationkey group by 1"""


def _words(names, out):
    terms = " + ".join(f"(case when contains(lower(text), '{w}') then 1 else 0 end)" for w in names)
    return f"({terms})::int {out}"


def _sentiment():
    from strataglean.functions.text import NEGATIVE_WORDS, POSITIVE_WORDS

    return f"select doc_id, {_words(POSITIVE_WORDS, 'positive')}, {_words(NEGATIVE_WORDS, 'negative')} from documents"


# The attribute record, restated from the part columns it is made of.
_AMBIENT = {"romantic": "p_size % 2", "classy": "p_size % 3", "trendy": "p_size % 5"}
BUSINESS_SQL = "select p_partkey business_id, " + ", ".join(
    [
        "(case when p_size % 10 = 0 then -1 else p_size % 4 + 1 end)::int price_range",
        "(case when p_size % 10 <> 0 and p_size % 7 = 0 then 1 else 0 end)::int outdoor_seating",
        "(case when p_size % 10 <> 0 and p_size % 3 <> 0 then 1 else 0 end)::int alcohol",
        "(case when p_size % 10 <> 0 and p_size % 4 = 0 then 1 else 0 end)::int wifi",
        "(case when p_size % 2 = 0 then 1 else 0 end)::int is_restaurant",
        "(case when p_size % 5 = 0 then 1 else 0 end)::int is_food",
    ]
    + [
        f"(case when p_size % 10 <> 0 and {_AMBIENT[key]} = 0 then 1 else 0 end)::int {key}"
        if key in _AMBIENT else f"0::int {key}"
        for key in AMBIENCE
    ]
) + " from part"

ORACLES = {
    "scan_json": """select event_id, user_id, event_type, value,
        regexp_extract(props, '"k": (-?[0-9]+)', 1)::int k from events""",
    "scan_csv": "select c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment from customer",
    "parse_vectors": """select vec_id id, label, unnest(range(len(embedding)))::bigint dim,
        round(unnest(embedding)::double, 6) "value" from embeddings""",
    "basket_preprocess": """select distinct strftime(o_orderdate, '%-m/%-d/%y') || '-' || o_custkey basket,
        l_partkey::varchar item from lineitem join orders on l_orderkey = o_orderkey""",
    "sink_roundtrip_csv": _CITY,
    "city_avg_stars": _CITY,
    "metrics_json": f"""with {REVIEWS},
        u as (select user_id k, count(*) n from reviews group by 1 order by n desc, k limit 10),
        i as (select item_id k, count(*) n from reviews group by 1 order by n desc, k limit 10)
        select '{{"n_review":' || count(*) || ',"n_review_year":' || count(*) filter (where year("day") = {YEAR})
          || ',"n_user":' || count(distinct user_id) || ',"n_business":' || count(distinct item_id)
          || ',"avg_stars":' || round(sum(stars) / count(*), 6)
          || ',"top10_user":[' || (select string_agg('["' || k || '","' || n || '"]', ',' order by n desc, k) from u)
          || '],"top10_business":[' || (select string_agg('["' || k || '","' || n || '"]', ',' order by n desc, k) from i)
          || ']}}' json from reviews""",
    "partition_profile": f"""with {REVIEWS}, k as (select distinct item_id from reviews)
        select 8::bigint n_partition, p::bigint partition, count(item_id) n_items from range(8) r(p)
        left join k on ('0x' || substr(md5(item_id::varchar), 1, 8))::bigint % 100 % 8 = p group by p""",
    "text_partitions": f"""with {REVIEWS} select count(*) n_items, count(distinct user_id || ',' || item_id) n_lines,
        true spread from reviews""",
    "count_in_year": f"""with {REVIEWS} select count(*) filter (where strftime("day", '%Y-%m-%d') like '%{YEAR}%') n_text,
        count(*) filter (where year("day") = {YEAR}) n_year from reviews""",
    "having_min_size": f"""with {REVIEWS} select user_id, count(distinct item_id) n from reviews
        group by 1 having count(distinct item_id) > 30""",
    "prefix_filter": """select l_partkey::varchar item, count(*) n from lineitem
        where l_partkey::varchar not like '1%' group by 1""",
    "overview_metrics": f"""with {REVIEWS} select count(*) n_review,
        count(*) filter (where year("day") = {YEAR}) n_review_year, count(distinct user_id) n_user,
        count(distinct item_id) n_business, round(sum(stars) / count(*), 6) avg_stars from reviews""",
    "count_by_key": f"with {REVIEWS} select item_id as key, count(*) n from reviews group by 1",
    "top_users": f"""with {REVIEWS} select user_id as key, count(*) n from reviews
        group by 1 order by n desc, key limit 10""",
    "top_businesses": f"""with {REVIEWS} select item_id as key, count(*) n from reviews
        group by 1 order by n desc, key limit 10""",
    "user_item_averages": f"""with {REVIEWS}
        select 'user' kind, user_id id, round(sum(stars) / count(*), 6) avg_stars, count(*) n from reviews group by 2
        union all select 'item', item_id, round(sum(stars) / count(*), 6), count(*) from reviews group by 2""",
    "distinct_pairs": f"with {REVIEWS} select distinct user_id, item_id from reviews",
    "latest_rating": f"""with {REVIEWS} select user_id, item_id, stars from reviews
        qualify row_number() over (partition by user_id, item_id order by "day" desc, stars desc) = 1""",
    "interaction_zscore": f"""with {REVIEWS}, train as (select * from reviews where "day" < '{roles.SPLIT_DAY}'),
        u as (select user_id, sum(stars) / count(*) a from train group by 1),
        i as (select item_id, sum(stars) / count(*) b from train group by 1),
        s as (select avg(a * b) m, stddev_pop(a * b) sd from train join u using (user_id) join i using (item_id))
        select distinct user_id, item_id, round((a * b - m) / sd, 6) z
        from train join u using (user_id) join i using (item_id), s""",
    "dense_index": """select id, (row_number() over (order by id) - 1)::bigint as index
        from (select distinct l_partkey::varchar id from lineitem)""",
    "split_sample": """select c_custkey,
        ('0x' || substr(md5(c_custkey::varchar || '|sample'), 1, 8))::bigint % 100 < 20 sampled from customer""",
    "sentiment_counts": _sentiment(),
    "string_mod_hash": """with t as (select c_name id, list_transform(range(1, strlen(c_name) + 1),
          lambda i: ascii(substr(c_name, i, 1))::bigint) codes from customer),
        r as (select id, list_reduce(codes, lambda acc, c: (acc * 256 + c) % 69997) x,
          list_reduce(codes, lambda acc, c: (acc * 256 + c) % 701) y from t)
        select id, (131 * x + 103) % 69997 h0, ((137 * y + 107) % 701) % 69997 h1,
          (149 * x + 109) % 69997 h2 from r""",
    "trailing_zeros": """select o_orderkey, case when o_orderkey = 0 then 0
        else (length(bin(o_orderkey)) - length(rtrim(bin(o_orderkey), '0')))::bigint end zeros from orders""",
    "business_features": BUSINESS_SQL,
}
