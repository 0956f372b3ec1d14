"""Recommenders: ratings before the split day train, later pairs are predicted."""

from __future__ import annotations

from pyspark.sql import functions as F

from strataglean.functions.text import AMBIENCE, NEGATIVE_WORDS, POSITIVE_WORDS
from strataglean.operators import boosting, recommend, relational
from strataglean.plans.explore import BUSINESS_SQL
from strataglean.session import cut_lineage
from strataglean.sources import roles

# Co-raters needed for Pearson, weights of both blends, the two columns of the second.
MIN_CO_RATERS, W_CF, W_MODEL, TWO_BLEND = 7, 0.01, 0.99, (0.3, 0.7)
TWO_COLUMNS = ["average_stars", "stars"]
COLD_DAY = "1995-03-01"
# Parts of each feature's range that the cuts of boosted_root_splits lie between.
EVEN_BINS = 32


def _targets(spark, sf, item="l_suppkey"):
    return roles.test_reviews(spark, sf, item).select("user_id", "item_id").distinct()


def item_pearson(spark, sf):
    latest = cut_lineage(recommend.latest_ratings(roles.train_reviews(spark, sf)))
    pairs = cut_lineage(recommend.item_pairs_for(latest, _targets(spark, sf)))
    return recommend.item_pearson(latest, pairs).withColumn("pearson", F.round("pearson", 6))


def item_weights(spark, sf):
    """Parts as items: few co-raters, so most weights come from the means."""
    train = cut_lineage(roles.train_reviews(spark, sf, "l_partkey"))
    latest = cut_lineage(recommend.latest_ratings(train))
    pairs = cut_lineage(recommend.item_pairs_for(latest, _targets(spark, sf, "l_partkey")))
    return recommend.item_weights(train, latest, pairs, 5).withColumn("weight", F.round("weight", 6))


def _cf(spark, sf):
    train = cut_lineage(roles.train_reviews(spark, sf))
    return recommend.cf_predict(train, cut_lineage(_targets(spark, sf)), MIN_CO_RATERS)


def _round(df):
    return df.withColumn("prediction", F.round("prediction", 6))


def cf_predict(spark, sf):
    return _round(_cf(spark, sf))


def cf_cold_start(spark, sf):
    """An early split day, so that many users and parts are unseen."""
    reviews = roles.reviews(spark, sf, "l_partkey")
    early = F.col("day") < F.lit(COLD_DAY).cast("timestamp_ntz")
    targets = reviews.filter(~early).select("user_id", "item_id").distinct()
    return _round(recommend.cold_start(reviews.filter(early), targets))


def feature_lookup(spark, sf):
    train = roles.train_reviews(spark, sf, "l_partkey")
    features = recommend.rating_features(
        _targets(spark, sf, "l_partkey"),
        recommend.user_table(train).drop("user_review_count"),
        recommend.item_table(train).drop("review_count"))
    return features.select(
        "user_id", "item_id", F.round("average_stars", 6).alias("average_stars"), F.round("stars", 6).alias("stars"))


def _kept_train(spark, sf, item):
    """The training reviews, kept: means, statistics and labels read them again."""
    return cut_lineage(roles.train_reviews(spark, sf, item))


def _matrix(spark, sf, pairs, train=None):
    train = _kept_train(spark, sf, "l_partkey") if train is None else train
    return recommend.feature_matrix(
        pairs, train.select("user_id", "item_id"), train, roles.business_records(spark, sf),
        roles.tips(spark, sf))


def feature_matrix(spark, sf):
    rows = _matrix(spark, sf, _targets(spark, sf, "l_partkey"))
    return rows.select("user_id", "item_id", *[F.round(c, 6).alias(c) for c in recommend.FEATURES])


def _labelled(spark, sf, item, train=None):
    train = recommend.latest_ratings(roles.train_reviews(spark, sf, item) if train is None else train)
    return train.select("user_id", "item_id", F.col("stars").cast("double").alias("label"))


def _two_columns(spark, sf, pairs):
    """The user's and the item's mean of each pair."""
    train = roles.train_reviews(spark, sf)
    return recommend.rating_features(
        pairs, recommend.user_table(train).drop("user_review_count"), recommend.item_table(train).drop("review_count"))


# Fitted models by session, folder and kind: several queries ask for the same one.
_FITTED = {}


def _trees(spark, sf, kind):
    """(model, training rows, feature names) of the 19-column or the two-column model."""
    key = spark.sparkContext.applicationId, sf, kind
    if key not in _FITTED:
        if kind == "all":
            train = _kept_train(spark, sf, "l_partkey")
            rows, names = _matrix(spark, sf, _labelled(spark, sf, "l_partkey", train), train), recommend.FEATURES
        else:
            rows, names = _two_columns(spark, sf, _labelled(spark, sf, "l_suppkey")), TWO_COLUMNS
        rows = cut_lineage(rows)
        _FITTED[key] = recommend.fit_boosted_trees(rows, "label", names), rows, names
    return _FITTED[key]


def _tree_scores(spark, sf, kind):
    model, _, names = _trees(spark, sf, kind)
    if kind == "all":
        rows = _matrix(spark, sf, _targets(spark, sf, "l_partkey"))
    else:
        rows = _two_columns(spark, sf, _targets(spark, sf))
    return recommend.predict_boosted_trees(model, rows, names)


def _plausible(df):
    """Predictions of a fitted model are no SQL; that they are near the scale of stars is."""
    return df.select("user_id", "item_id", F.col("prediction").between(-1, 7).alias("plausible"))


def _predictions(df):
    return df.select("user_id", "item_id", "prediction")


def gbt_predictions(spark, sf):
    return _predictions(_tree_scores(spark, sf, "all"))


def gbt_two_column_predictions(spark, sf):
    return _predictions(_tree_scores(spark, sf, "two"))


def gbt_predict(spark, sf):
    return _plausible(gbt_predictions(spark, sf))


def gbt_two_columns(spark, sf):
    return _plausible(gbt_two_column_predictions(spark, sf))


def gbt_importance(spark, sf):
    """The features, whether each weight is a share, and whether the shares add up to 1."""
    model, _, names = _trees(spark, sf, "all")
    found = recommend.feature_importance(model, spark, names)
    total = found.agg(F.abs(F.sum("importance") - 1).alias("off"))
    return found.crossJoin(F.broadcast(total)).select(  # one row
        "feature", (F.col("importance").between(0, 1) & (F.col("off") < 1e-6)).alias("is_share"))


def boosted_root_splits(spark, sf):
    """The first tree's cuts of all training rows: their gains and the rows that go left."""
    names, train = recommend.FEATURES, _kept_train(spark, sf, "l_partkey")
    rows = _matrix(spark, sf, _labelled(spark, sf, "l_partkey", train), train).select("label", *[F.round(c, 6).alias(c) for c in names])
    rows = cut_lineage(rows.withColumn("price_range", F.expr("nullif(price_range, -1)")))
    table = boosting.binned(rows, "label", names, boosting.even_edges(rows, names, EVEN_BINS), 0.5)
    sums = boosting.histogram(table, len(names), [], boosting.Tree(1), 0)
    feature = F.get(F.array(*map(F.lit, names)), F.col("feature").cast("int"))
    return boosting.split_gains(sums).filter(boosting.allowed()).select(
        feature.alias("feature"), "cut", "missing_left", F.col("hl").cast("long").alias("n_left"),
        F.round("gain", 6).alias("gain"))


def boosted_predictions(spark, sf):
    """Targets scored by 20 second-order trees of three levels on the user's and the item's mean."""
    rows = cut_lineage(_two_columns(spark, sf, _labelled(spark, sf, "l_suppkey")))
    model = boosting.fit_trees(rows, "label", TWO_COLUMNS, rounds=20, step=0.3)
    return _predictions(boosting.predict_trees(model, _two_columns(spark, sf, _targets(spark, sf))))


def _hybrid(spark, sf, kind):
    """Collaborative scores blended with those of the trees."""
    item, k, weights = ("l_partkey", 5, (W_CF, W_MODEL)) if kind == "all" else ("l_suppkey", MIN_CO_RATERS, TWO_BLEND)
    train = cut_lineage(roles.train_reviews(spark, sf, item))
    scores = recommend.cf_predict(train, cut_lineage(_targets(spark, sf, item)), k)
    return recommend.hybrid_blend(scores, _tree_scores(spark, sf, kind), *weights)


def hybrid_predictions(spark, sf):
    return _predictions(_hybrid(spark, sf, "all"))


def hybrid_two_column_predictions(spark, sf):
    return _predictions(_hybrid(spark, sf, "two"))


def hybrid_blend(spark, sf):
    return _plausible(hybrid_predictions(spark, sf))


def hybrid_two_columns(spark, sf):
    return _plausible(hybrid_two_column_predictions(spark, sf))


def _scored(spark, sf):
    truth = recommend.latest_ratings(roles.test_reviews(spark, sf, "l_partkey"))
    return _hybrid(spark, sf, "all").join(truth, ["user_id", "item_id"])


def hybrid_rmse(spark, sf):
    """Targets scored and their error."""
    return relational.rmse(_scored(spark, sf), "stars", "prediction")


def rmse_eval(spark, sf):
    """Targets scored; whether the error is one of stars, and on training rows below that of the mean."""
    model, rows, names = _trees(spark, sf, "all")
    fitted = recommend.predict_boosted_trees(model, rows, names).join(
        rows.select("user_id", "item_id", "label"), ["user_id", "item_id"])
    inside = relational.rmse(fitted, "label", "prediction").withColumnsRenamed({"n": "n_train", "rmse": "trained"})
    spread = rows.agg(F.stddev_pop("label").alias("spread"))
    outside = hybrid_rmse(spark, sf)
    return outside.crossJoin(F.broadcast(inside)).crossJoin(F.broadcast(spread)).select(  # one row each
        "n", "n_train", F.col("rmse").between(0, 5).alias("in_stars"),
        (F.col("trained") < F.col("spread")).alias("below_mean"))


def hybrid_error_bins(spark, sf):
    """Error bins of the scored targets and their counts."""
    return relational.error_histogram(_scored(spark, sf), "stars", "prediction")


def error_histogram(spark, sf):
    """The bins, and whether together they hold no more than the scored targets."""
    scored = cut_lineage(_scored(spark, sf))
    bins = relational.error_histogram(scored, "stars", "prediction")
    total = bins.agg(F.sum("n").alias("in_bins")).crossJoin(scored.agg(F.count(F.lit(1)).alias("n_scored")))
    return bins.crossJoin(F.broadcast(total)).select(  # one row
        "bin", (F.col("n").between(0, F.col("n_scored")) & (F.col("in_bins") <= F.col("n_scored"))).alias("complete"),
        "n_scored")


def error_bins(spark, sf):
    """Collaborative predictions alone: error bins and their counts."""
    truth = recommend.latest_ratings(roles.test_reviews(spark, sf))
    return relational.error_histogram(_cf(spark, sf).join(truth, ["user_id", "item_id"]), "stars", "prediction")


def cf_rmse(spark, sf):
    truth = recommend.latest_ratings(roles.test_reviews(spark, sf))
    scored = _cf(spark, sf).join(truth, ["user_id", "item_id"])
    return relational.rmse(scored, "stars", "prediction").withColumn("rmse", F.round("rmse", 6))


def mean_blend(spark, sf):
    """Collaborative score blended with the mean of the user's and the item's average."""
    train, targets = roles.train_reviews(spark, sf), _targets(spark, sf)
    base = recommend.rating_features(
        targets, recommend.user_table(train), recommend.item_table(train)
    ).select("user_id", "item_id", ((F.col("average_stars") + F.col("stars")) / 2).alias("prediction"))
    return _round(recommend.hybrid_blend(_cf(spark, sf), base, W_CF, W_MODEL))


QUERIES = {
    "item_pearson": item_pearson, "item_weights": item_weights, "cf_predict": cf_predict,
    "cf_cold_start": cf_cold_start, "feature_lookup": feature_lookup,
    "feature_matrix": feature_matrix, "gbt_predict": gbt_predict, "gbt_importance": gbt_importance,
    "gbt_two_columns": gbt_two_columns, "hybrid_blend": hybrid_blend, "hybrid_two_columns": hybrid_two_columns,
    "rmse_eval": rmse_eval, "error_histogram": error_histogram, "mean_blend": mean_blend, "cf_rmse": cf_rmse,
    "error_bins": error_bins, "boosted_root_splits": boosted_root_splits,
    # Without SQL: what the facts above are about.
    "gbt_predictions": gbt_predictions, "gbt_two_column_predictions": gbt_two_column_predictions,
    "hybrid_predictions": hybrid_predictions, "hybrid_two_column_predictions": hybrid_two_column_predictions,
    "boosted_predictions": boosted_predictions, "hybrid_rmse": hybrid_rmse, "hybrid_error_bins": hybrid_error_bins,
}


def _base(item, split=roles.SPLIT_DAY):
    return f"""reviews as (
  select o_custkey user_id, {item} item_id, (1 + l_quantity::int % 5)::int stars, o_orderdate "day"
  from lineitem join orders on l_orderkey = o_orderkey),
train as (select * from reviews where "day" < '{split}'),
test as (select * from reviews where "day" >= '{split}'),
latest as (select user_id, item_id, stars from train
  qualify row_number() over (partition by user_id, item_id order by "day" desc, stars desc) = 1),
targets as (select distinct user_id, item_id from test),
umean as (select user_id, sum(stars) / count(*) a, count(*) n from train group by 1),
imean as (select item_id, sum(stars) / count(*) a, count(*) n from train group by 1)"""


_PEARSON = """pairs as (select distinct least(t.item_id, l.item_id) item_1, greatest(t.item_id, l.item_id) item_2
  from targets t join latest l using (user_id) where t.item_id in (select item_id from latest)),
mom as (select item_1, item_2, count(*)::bigint n, sum(x.stars)::bigint sx, sum(y.stars)::bigint sy,
    sum(x.stars * x.stars)::bigint sxx, sum(y.stars * y.stars)::bigint syy, sum(x.stars * y.stars)::bigint sxy
  from pairs join latest x on x.item_id = item_1 join latest y on y.item_id = item_2 and y.user_id = x.user_id
  group by 1, 2),
pear as (select item_1, item_2, n, case when n * sxx = sx * sx or n * syy = sy * sy then 0.0::double else
    (n * sxy - sx * sy) / (sqrt((n * sxx - sx * sx)::double) * sqrt((n * syy - sy * sy)::double)) end pearson from mom)"""


def _weights(k):
    return f"""wts as (select item_1, item_2, coalesce(pear.n, 0)::bigint n,
    case when coalesce(pear.n, 0) >= {k} then pearson else (5.0::double - abs(i1.a - i2.a)) / 5.0::double end weight
  from pairs left join pear using (item_1, item_2)
  join imean i1 on i1.item_id = item_1 join imean i2 on i2.item_id = item_2)"""


_CF = f"""with {_base("l_suppkey")}, {_PEARSON}, {_weights(MIN_CO_RATERS)},
ranked as (select t.user_id, t.item_id, weight, l.stars,
    row_number() over (partition by t.user_id, t.item_id order by weight desc, l.item_id) r
  from targets t join latest l using (user_id)
  join wts on item_1 = least(t.item_id, l.item_id) and item_2 = greatest(t.item_id, l.item_id)),
scored as (select user_id, item_id, sum(weight * stars) num, sum(abs(weight)) den from ranked where r <= 600 group by 1, 2),
cf as (select t.user_id, t.item_id, case
    when u.a is null or i.a is null then coalesce(u.a, 3.0)
    when den is null or den = 0 then 3.0 else num / den end prediction
  from targets t left join umean u using (user_id) left join imean i using (item_id)
  left join scored s on s.user_id = t.user_id and s.item_id = t.item_id)"""

_BLEND = f"""{_CF}, blend as (select user_id, item_id,
    prediction * {W_CF} + ((coalesce(u.a, 0) + coalesce(i.a, 0)) / 2) * {W_MODEL} prediction
  from cf left join umean u using (user_id) left join imean i using (item_id))"""

_ERR = f"""{_CF}, truth as (select user_id, item_id, stars from test
  qualify row_number() over (partition by user_id, item_id order by "day" desc, stars desc) = 1),
err as (select abs(stars - prediction) e from cf join truth using (user_id, item_id))"""


def _keys(item):
    return f"with {_base(item)} select user_id, item_id, true plausible from targets"



def _count(words):
    return "(" + " + ".join(f"(case when contains(lower(text), '{w}') then 1 else 0 end)" for w in words) + ")"


def _matrix_sql(rows="targets", more=""):
    """The features of ``rows``, whose alias is t, after the columns ``more`` of theirs."""
    zeros = ["outdoor_seating", "alcohol", "wifi", "is_restaurant", "is_food", *AMBIENCE]
    flags = ", ".join(f"coalesce({c}, 0)::double {c}" for c in zeros)
    return f"""with {_base("l_partkey")}, biz as ({BUSINESS_SQL}),
    st as (select avg(u.a * i.a) m, stddev_pop(u.a * i.a) sd from train join umean u using (user_id) join imean i using (item_id)),
    tip as (select o_custkey user_id, item_id, sum({_count(POSITIVE_WORDS)}) pos, sum({_count(NEGATIVE_WORDS)}) neg
      from documents join orders on doc_id = o_orderkey
      join (select l_orderkey, min(l_partkey) item_id from lineitem group by 1) on l_orderkey = doc_id group by 1, 2)
    select {more} t.user_id, t.item_id, round(coalesce(u.a, 0), 6) average_stars, round(coalesce(i.a, 0), 6) stars,
      round((coalesce(u.a, 0) * coalesce(i.a, 0) - m) / sd, 6) interaction, coalesce(i.n, 0)::double review_count,
      coalesce(price_range, -1)::double price_range, {flags}, coalesce(u.n, 0)::double user_review_count,
      coalesce(pos, 0)::double positive, coalesce(neg, 0)::double negative
    from {rows} t left join umean u using (user_id) left join imean i using (item_id)
    left join biz on business_id = t.item_id left join tip on tip.user_id = t.user_id and tip.item_id = t.item_id, st"""


def _root_splits_sql():
    names, values = (", ".join(f.format(c) for c in recommend.FEATURES) for f in ("'{}'", "{}"))
    values = values.replace("price_range", "nullif(price_range, -1)")
    return f"""with m as ({_matrix_sql("latest", "t.stars::double label,")}),
long as (select 0.5::double - label g, unnest([{names}]) feature, unnest([{values}]) x from m),
ends as (select feature, min(x) lo, max(x) hi from long group by 1),
dealt as (select feature, g, case when x is null then 0
    else 1 + len(list_filter(range(1, {EVEN_BINS}), lambda i: lo + (hi - lo) * i / {EVEN_BINS} <= x)) end cut
  from long join ends using (feature)),
hist as (select feature, cut, sum(g) g, count(*)::double h from dealt group by 1, 2),
own as (select feature, sum(g) ga, sum(h) ha, sum(case when cut = 0 then g else 0 end) gm,
    sum(case when cut = 0 then h else 0 end) hm from hist group by 1),
upto as (select feature, cut, sum(g) over w gc, sum(h) over w hc from hist where cut > 0
  window w as (partition by feature order by cut)),
sides as (select feature, cut, missing_left, ga, ha, gc + case when missing_left then gm else 0 end gl,
    hc + case when missing_left then hm else 0 end hl
  from upto join own using (feature) cross join (values (true), (false)) d(missing_left))
select feature, cut::bigint cut, missing_left, hl::bigint n_left, round(
  gl * gl / (hl + 1) + (ga - gl) * (ga - gl) / (ha - hl + 1) - ga * ga / (ha + 1), 6) gain
from sides where hl >= 1 and ha - hl >= 1"""


ORACLES = {
    "boosted_root_splits": _root_splits_sql(),
    "item_pearson": f"""with {_base("l_suppkey")}, {_PEARSON}
        select item_1, item_2, n, round(pearson, 6) pearson from pear""",
    "item_weights": f"""with {_base("l_partkey")}, {_PEARSON}, {_weights(5)}
        select item_1, item_2, n, round(weight, 6) weight from wts""",
    "cf_predict": f"{_CF} select user_id, item_id, round(prediction, 6) prediction from cf",
    "cf_cold_start": f"""with {_base("l_partkey", COLD_DAY)}
        select user_id, item_id, round(coalesce(u.a, 3.0), 6) prediction from targets
        left join umean u using (user_id) left join imean i using (item_id) where u.a is null or i.a is null""",
    "feature_lookup": f"""with {_base("l_partkey")} select user_id, item_id,
        round(coalesce(u.a, 0), 6) average_stars, round(coalesce(i.a, 0), 6) stars
        from targets left join umean u using (user_id) left join imean i using (item_id)""",
    "feature_matrix": _matrix_sql(),
    "mean_blend": f"{_BLEND} select user_id, item_id, round(prediction, 6) prediction from blend",
    "cf_rmse": f"{_ERR} select count(*) n, round(sqrt(avg(e * e)), 6) rmse from err",
    "error_bins": f"""{_ERR} select b::bigint bin, count(e) n from range(0, 5) r(b)
        left join err on e >= b and e < b + 1 group by 1""",
    "gbt_predict": _keys("l_partkey"), "hybrid_blend": _keys("l_partkey"),
    "gbt_two_columns": _keys("l_suppkey"), "hybrid_two_columns": _keys("l_suppkey"),
    "gbt_importance": f"""select unnest([{", ".join(f"'{f}'" for f in recommend.FEATURES)}]) feature, true is_share""",
    "rmse_eval": f"""with {_base("l_partkey")} select (select count(*) from targets) n, (select count(*) from latest) n_train,
        true in_stars, true below_mean""",
    "error_histogram": f"""with {_base("l_partkey")} select b::bigint bin, true complete, (select count(*) from targets) n_scored
        from range(0, 5) r(b)""",
}
