"""Machine learning on tables: fitted models, diagnostics and experiments."""

from __future__ import annotations

import math

from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.clustering import LDA, GaussianMixture, KMeans
from pyspark.ml.feature import IDF, CountVectorizer, NGram, RegexTokenizer, RobustScaler, StopWordsRemover
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import AFTSurvivalRegression, GeneralizedLinearRegression, LinearRegression, RandomForestRegressor
from pyspark.ml.stat import Correlation
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.rules import first_of, ratio
from ..operators import models
from ..operators.quantiles import discrete_quantiles, exact_quantiles, grouped_quantiles
from ..registry import Tables, query
from ..session import ship_code, written
from .forecast import fc02
from .mapping import PM, leads, project_months
from .marts import LC, landmarks, lead_conversions


def scored_leads(t: Tables) -> DataFrame:
    """Leads with a 60-day label that had time to mature."""
    y = F.coalesce(F.col("days").between(0, 60), F.lit(False)).cast("int")
    return lead_conversions(t).where(F.date_add("d", 60) <= "2001-06-01").select("lead", "project", "channel", "seller", "amount", "d", "converted", "days", y.alias("y"))


S = f"{LC}, s AS (SELECT *, CAST(coalesce(days BETWEEN 0 AND 60, FALSE) AS INTEGER) AS y FROM lc WHERE d+60<=DATE '2001-06-01')"


@query("ml01_random_forest")
def ml01(t: Tables) -> DataFrame:
    """Pooled panel, months before 2000 to learn from: mean absolute errors on later ones of a forest and of the mixture's analogues."""
    panel = models.assembled(fc02(t).where("label is not null and lag1 is not null").withColumn("label", F.col("label").cast("double")), ["mean3", "lag1"])
    train, test = panel.where("month < '2000-01-01'"), panel.where("month >= '2000-01-01'")
    forest = RandomForestRegressor(labelCol="label", numTrees=20, maxDepth=5, seed=7).fit(train)
    k, mixture = models.choose_mixture(train, (2, 3, 4))
    error = lambda df, name, used: df.agg(F.lit(name).alias("model"), F.lit(used).alias("components"), F.count("*").alias("n"), F.avg(F.abs(F.col("prediction") - F.col("label"))).alias("mae"))
    return error(forest.transform(test), "random_forest", None).unionByName(error(models.analogue(mixture, train, test, "label"), "gmm_analog", k))


@query("ml02_logistic")
def ml02(t: Tables) -> DataFrame:
    s = scored_leads(t)
    model = models.balanced_logistic(s.where("d < '1999-01-01'"), "y", ["amount"], ["channel", "seller"])
    return models.probability(model, s.where("d >= '1999-01-01'")).select("lead", "y", "p")


@query("ml03_unit_sale_probability")
def ml03(t: Tables) -> DataFrame:
    """For each landmark: the model, or the base rate where the model's Brier score isn't below 98 % of the base rate's."""
    out = None
    every = written(landmarks(t).where(F.col("l").isin(0, 30, 60) & F.col("label").isNotNull()).join(leads(t).select("lead", "d", "amount", "channel"), "lead"), "landmarks")
    for lm in (0, 30, 60):
        rows = every.where(F.col("l") == lm)
        train = rows.where("d < '1999-01-01'")
        base = train.agg(F.avg("label")).first()[0] or 0.0
        model = models.balanced_logistic(train, "label", ["amount"], ["channel"])
        test = models.probability(model, rows.where("d >= '1999-04-01'"))
        brier = lambda p: F.avg((p - F.col("label")) ** 2)
        one = test.agg(F.lit(lm).alias("l"), F.count("*").alias("n"), brier(F.col("p")).alias("model"), brier(F.lit(base)).alias("base")).withColumn("used", F.when(F.col("model") < 0.98 * F.col("base"), "MODEL").otherwise("BASE_RATE"))
        out = one if out is None else out.unionByName(one)
    return out


@query("ml04_fall_risk_benchmark")
def ml04(t: Tables) -> DataFrame:
    """Three models and the base rate on later leads: areas, Brier score, calibration error, and precision among the 100 likeliest."""
    s = models.assembled(written(scored_leads(t).select("lead", "d", "amount", "project", F.col("y").cast("double").alias("label")), "leads"), ["amount", "project"])
    train, test = s.where("d < '1999-01-01'"), s.where("d >= '1999-01-01'")
    base = train.agg(F.avg("label")).first()[0] or 0.0
    fits = {"logistic": LogisticRegression(maxIter=50, regParam=0.01, labelCol="label"), "forest": RandomForestClassifier(labelCol="label", numTrees=20, maxDepth=5, seed=7), "boosted": GBTClassifier(labelCol="label", maxIter=5, maxDepth=3, seed=7)}
    scored = {name: f.fit(train).transform(test).select("lead", "label", vector_to_array("probability")[1].alias("p")) for name, f in fits.items()} | {"base_rate": test.select("lead", "label", F.lit(base).alias("p"))}
    out = None
    for name, p in scored.items():
        one = models.binary_metrics(written(p, "scored"), "lead").withColumn("model", F.lit(name))
        out = one if out is None else out.unionByName(one)
    return out


@query("ml06_did", f"WITH {S}, g AS (SELECT channel='BUILDING' AS treated, d>=DATE '1998-01-01' AS post, avg(y) AS m, count(*)::DOUBLE AS n, var_samp(y) AS v FROM s GROUP BY 1,2) SELECT round((sum(m) FILTER (treated AND post)-sum(m) FILTER (treated AND NOT post))-(sum(m) FILTER (NOT treated AND post)-sum(m) FILTER (NOT treated AND NOT post)),8) AS effect, round(sqrt(sum(v/n)),8) AS se FROM g")
def ml06(t: Tables) -> DataFrame:
    g = scored_leads(t).groupBy((F.col("channel") == "BUILDING").alias("treated"), (F.col("d") >= "1998-01-01").alias("post")).agg(F.avg("y").alias("m"), F.count("*").alias("n"), F.var_samp("y").alias("v"))
    sign = F.when(F.col("treated") == F.col("post"), 1.0).otherwise(-1.0)
    return g.agg(F.round(F.sum(sign * F.col("m")), 8).alias("effect"), F.round(F.sqrt(F.sum(F.col("v") / F.col("n"))), 8).alias("se"))


@query("ml07_ipw_ate")
def ml07(t: Tables, cost: float = 50.0) -> DataFrame:
    """The effect weighted by inverse propensities, the plain difference, the balance of amounts before and after weighting (standardised
    mean differences), and what the effect is worth a lead less a cost."""
    s = scored_leads(t).withColumn("treated", (F.col("channel") == "BUILDING").cast("int"))
    w = models.probability(models.balanced_logistic(s, "treated", ["amount"], ["seller"]), s).withColumn("p", F.greatest(F.lit(0.02), F.least(F.lit(0.98), "p")))
    a, b = F.col("treated") / F.col("p"), (1 - F.col("treated")) / (1 - F.col("p"))
    mean = lambda weight, x: F.sum(weight * F.col(x)) / F.sum(weight)
    spread = F.sqrt((F.var_samp(F.when(F.col("treated") == 1, F.col("amount"))) + F.var_samp(F.when(F.col("treated") == 0, F.col("amount")))) / 2)
    one, none = F.col("treated").cast("double"), 1.0 - F.col("treated")
    ate = mean(a, "y") - mean(b, "y")
    return w.agg(ate.alias("ate"), (mean(one, "y") - mean(none, "y")).alias("crude"), F.count("*").alias("n"), ((mean(one, "amount") - mean(none, "amount")) / spread).alias("smd_before"), ((mean(a, "amount") - mean(b, "amount")) / spread).alias("smd_after"), (ate * F.avg("amount") - cost).alias("net_value"))


@query("ml08_psi", "WITH r AS (SELECT o_totalprice AS x FROM orders WHERE o_orderdate<TIMESTAMP '1998-01-01'), c AS (SELECT o_totalprice AS x FROM orders WHERE o_orderdate>=TIMESTAMP '1998-01-01'), e AS (SELECT (x>50000)::INT+(x>100000)::INT+(x>150000)::INT AS bin, 0 AS w FROM r UNION ALL SELECT (x>50000)::INT+(x>100000)::INT+(x>150000)::INT, 1 FROM c), g AS (SELECT bin, count(*) FILTER (w=0)+0.5::DOUBLE AS r, count(*) FILTER (w=1)+0.5::DOUBLE AS c FROM e GROUP BY 1), p AS (SELECT r/sum(r) OVER () AS a, c/sum(c) OVER () AS b FROM g) SELECT round(sum((b-a)*ln(b/a)),8) AS psi, CASE WHEN sum((b-a)*ln(b/a))>0.25 THEN 'RETRAIN' WHEN sum((b-a)*ln(b/a))>0.1 THEN 'WATCH' ELSE 'STABLE' END AS drift FROM p")
def ml08(t: Tables) -> DataFrame:
    cut = F.lit("1998-01-01").cast("timestamp_ntz")
    x = models.psi(t.orders.where(F.col("o_orderdate") < cut), t.orders.where(F.col("o_orderdate") >= cut), "o_totalprice", [50000.0, 100000.0, 150000.0])
    return x.select(F.round("psi", 8).alias("psi"), first_of((F.col("psi") > 0.25, "RETRAIN"), (F.col("psi") > 0.1, "WATCH"), otherwise="STABLE").alias("drift"))


@query("ml09_series_profile", f"WITH {PM}, l AS (SELECT project, month, sales, lag(sales) OVER w AS prev, lag(sales,12) OVER w AS year_ago, row_number() OVER w AS i FROM pm WINDOW w AS (PARTITION BY project ORDER BY month)) SELECT project, count(*) AS n, CAST(date_diff('month', min(month), max(month))+1-count(*) AS BIGINT) AS missing, round(corr(sales, prev),6) AS acf1, round(corr(sales, year_ago),6) AS acf12, round(regr_slope(sales, i),6) AS slope, round(pow(stddev_samp(sales)/nullif(avg(sales),0),2),6) AS cv2, round(count(*)/nullif(count(*) FILTER (sales>0),0)::DOUBLE,6) AS adi, CASE WHEN count(*)<1.32*count(*) FILTER (sales>0) THEN CASE WHEN pow(stddev_samp(sales)/nullif(avg(sales),0),2)<0.49 THEN 'SMOOTH' ELSE 'ERRATIC' END ELSE CASE WHEN pow(stddev_samp(sales)/nullif(avg(sales),0),2)<0.49 THEN 'INTERMITTENT' ELSE 'LUMPY' END END AS demand FROM l GROUP BY 1")
def ml09(t: Tables) -> DataFrame:
    """Months without a row, autocorrelations, trend, variation, the mean interval between months with sales, and the kind of demand."""
    w = Window.partitionBy("project").orderBy("month")
    rows = project_months(t).withColumns({"prev": F.lag("sales").over(w), "year_ago": F.lag("sales", 12).over(w), "i": F.row_number().over(w)})
    cv2, sold = F.pow(ratio(F.stddev_samp("sales"), F.avg("sales")), F.lit(2)), F.count_if(F.col("sales") > 0)
    often, even = F.count("*") < 1.32 * sold, cv2 < 0.49
    kind = first_of((often & even, "SMOOTH"), (often, "ERRATIC"), (even, "INTERMITTENT"), otherwise="LUMPY")
    missing = (F.months_between(F.max("month"), F.min("month")).cast("long") + 1 - F.count("*")).alias("missing")
    return rows.groupBy("project").agg(F.count("*").alias("n"), missing, F.round(F.corr("sales", "prev"), 6).alias("acf1"), F.round(F.corr("sales", "year_ago"), 6).alias("acf12"), F.round(F.regr_slope("sales", "i"), 6).alias("slope"), F.round(cv2, 6).alias("cv2"), F.round(ratio(F.count("*"), sold), 6).alias("adi"), kind.alias("demand"))


@query("ml10_beta_binomial", f"WITH {S}, g AS (SELECT channel, sum(y)+1.0::DOUBLE AS a, count(*)-sum(y)+1.0::DOUBLE AS b FROM s GROUP BY 1) SELECT channel, round(a/(a+b),8) AS mean, round(a/(a+b)-1.96*sqrt(a*b/((a+b)*(a+b)*(a+b+1))),8) AS low_normal, round(a/(a+b)+1.96*sqrt(a*b/((a+b)*(a+b)*(a+b+1))),8) AS high_normal FROM g")
def ml10(t: Tables) -> DataFrame:
    g = scored_leads(t).groupBy("channel").agg((F.sum("y") + 1.0).alias("a"), (F.count("*") - F.sum("y") + 1.0).alias("b"))
    a, b = F.col("a"), F.col("b")
    half = 1.96 * F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))
    return g.select("channel", F.round(a / (a + b), 8).alias("mean"), F.round(a / (a + b) - half, 8).alias("low_normal"), F.round(a / (a + b) + half, 8).alias("high_normal"))


@query("ml11_empirical_survival", f"WITH {S}, g AS (SELECT least(coalesce(days,999),120) AS day, count(*) AS n FROM s WHERE coalesce(days,999)>=0 GROUP BY 1) SELECT CAST(day AS INTEGER) AS day, round(sum(n) OVER (ORDER BY day ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)/CAST(sum(n) OVER () AS DOUBLE),8) AS survival FROM g")
def ml11(t: Tables) -> DataFrame:
    """The last window is over one row a day."""
    g = scored_leads(t).withColumn("day", F.least(F.coalesce("days", F.lit(999)), F.lit(120))).where("day >= 0").groupBy("day").agg(F.count("*").alias("n"))
    every = Window.orderBy("day")
    return g.select("day", F.round(F.sum("n").over(every.rowsBetween(0, Window.unboundedFollowing)) / F.sum("n").over(every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)), 8).alias("survival"))


@query("ml12_latent_segments")
def ml12(t: Tables) -> DataFrame:
    """Fits and segments are those of all rows: equal rows are one point that weighs as many."""
    rows, n = models.points(models.assembled(t.customer, ["c_acctbal", "c_nationkey"]))
    fits = [(k, GaussianMixture(k=k, seed=7, weightCol="n").fit(rows)) for k in (2, 3, 4)]
    bic = {k: -2 * m.summary.logLikelihood + (6 * k - 1) * math.log(max(n, 1)) for k, m in fits}
    best = min(bic, key=bic.get)
    balance = F.sum(F.col("n") * vector_to_array("features")[0])
    return dict(fits)[best].transform(rows).groupBy(F.col("prediction").alias("segment")).agg(F.sum("n").alias("n"), (balance / F.sum("n")).alias("mean_balance")).withColumn("components", F.lit(best))


@query("ml12_calibration_bins")
def ml12_bins(t: Tables) -> DataFrame:
    """The mean chance and the rate in ten bins of the chance, over fixed tenths: no global sort."""
    s = scored_leads(t)
    p = models.probability(models.balanced_logistic(s.where("d < '1999-01-01'"), "y", ["amount"], ["channel", "seller"]), s.where("d >= '1999-01-01'"))
    return p.groupBy(F.least(F.lit(9), F.floor(F.col("p") * 10)).cast("int").alias("bin")).agg(F.count("*").alias("n"), F.avg("p").alias("mean_p"), F.avg("y").alias("rate"))


@query("ml13_reason_topics")
def ml13(t: Tables) -> DataFrame:
    """doc_id, topic, weight, terms: the topic of each text, how much of it is that topic's, and the topic's first terms.

    Terms are words and word pairs without stop words, in 5 texts at least and 60 % of them at most, the 3,000 most frequent (a parameter
    of the fit). All texts take part in counts, topics and weights. A text without terms has no topic.
    """
    texts = t.documents.where("text is not null").select("doc_id", "text").repartition("doc_id")  # a file of few row groups would be as few tasks
    words = RegexTokenizer(inputCol="text", outputCol="all", pattern=r"\P{L}+").transform(texts)
    words = StopWordsRemover(inputCol="all", outputCol="one", stopWords=[w for language in ("english", "spanish", "german", "french") for w in StopWordsRemover.loadDefaultStopWords(language)]).transform(words)
    terms = NGram(n=2, inputCol="one", outputCol="two").transform(words).select("doc_id", F.concat("one", "two").alias("words"))
    counts = CountVectorizer(inputCol="words", outputCol="tf", vocabSize=3000, minDF=5, maxDF=0.6).fit(terms)
    tf = written(counts.transform(terms).select("doc_id", "tf"), "terms")  # the rounds of the fit read counts, not texts
    idf = IDF(inputCol="tf", outputCol="features").fit(tf).transform(tf)
    fit = LDA(k=3, maxIter=20, seed=7).fit(idf)
    vocabulary = F.array(*map(F.lit, counts.vocabulary))
    topics = fit.describeTopics(5).select("topic", F.transform("termIndices", lambda i: F.element_at(vocabulary, i + 1)).alias("terms"))
    share = vector_to_array("topicDistribution")
    own = fit.transform(idf).select("doc_id", share.alias("share")).select("doc_id", (F.array_position("share", F.array_max("share")) - 1).cast("int").alias("topic"), F.array_max("share").alias("weight")).where("weight > 0")
    return own.join(F.broadcast(topics), "topic").select("doc_id", "topic", "weight", "terms")  # as many topics as k


@query("ml14_rank_by_value", f"WITH {S}, v AS (SELECT project, lead, round(amount*((lead%100)/1000.0::DOUBLE)-2000,6) AS value FROM s), r AS (SELECT *, row_number() OVER (PARTITION BY project ORDER BY value DESC, lead) AS place FROM v WHERE value>0) SELECT project, lead, value FROM r WHERE place<=20")
def ml14(t: Tables) -> DataFrame:
    v = scored_leads(t).select("project", "lead", F.round(F.col("amount") * ((F.col("lead") % 100) / 1000.0) - 2000, 6).alias("value")).where("value > 0")
    place = F.row_number().over(Window.partitionBy("project").orderBy(F.desc("value"), "lead"))
    return v.withColumn("place", place).where("place <= 20").drop("place")


@query("ml15_feedback_report", f"WITH {S} SELECT seller, count(*) AS n, round(avg((lead%2)::INT),8) AS action_rate, round(avg(y),8) AS outcome_rate, round(sum(amount*y),2) AS value, round(avg(pow((lead%100)/100.0::DOUBLE-y,2)),8) AS brier FROM s GROUP BY 1")
def ml15(t: Tables) -> DataFrame:
    return scored_leads(t).groupBy("seller").agg(F.count("*").alias("n"), F.round(F.avg(F.col("lead") % 2), 8).alias("action_rate"), F.round(F.avg("y"), 8).alias("outcome_rate"), F.round(F.sum(F.col("amount") * F.col("y")), 2).alias("value"), F.round(F.avg(F.pow((F.col("lead") % 100) / 100.0 - F.col("y"), F.lit(2))), 8).alias("brier"))


@query("ml16_linear_trend_forecast")
def ml16(t: Tables) -> DataFrame:
    ship_code(t.spark)
    return models.holt(project_months(t).select("project", "month", "sales"), "project", "month", "sales", 6)


@query("ml17_proportion_tests", f"WITH {S}, g AS (SELECT channel, count(*)::DOUBLE AS n, sum(y)::DOUBLE AS k FROM s GROUP BY 1), x AS (SELECT *, sum(n) OVER () AS tn, sum(k) OVER () AS tk FROM g) SELECT round(sum(pow(k-n*tk/tn,2)/(n*tk/tn)+pow((n-k)-n*(1-tk/tn),2)/(n*(1-tk/tn))),6) AS chi2, CAST(count(*)-1 AS BIGINT) AS df, round(sqrt(sum(pow(k-n*tk/tn,2)/(n*tk/tn)+pow((n-k)-n*(1-tk/tn),2)/(n*(1-tk/tn)))/max(tn)),8) AS cramer_v FROM x")
def ml17(t: Tables) -> DataFrame:
    g = scored_leads(t).groupBy("channel").agg(F.count("*").cast("double").alias("n"), F.sum("y").cast("double").alias("k"))
    x = g.crossJoin(F.broadcast(g.agg(F.sum("n").alias("tn"), F.sum("k").alias("tk"))))
    n, k, p = F.col("n"), F.col("k"), F.col("tk") / F.col("tn")
    chi2 = F.sum((k - n * p) ** 2 / (n * p) + ((n - k) - n * (1 - p)) ** 2 / (n * (1 - p)))
    return x.agg(F.round(chi2, 6).alias("chi2"), (F.count("*") - 1).alias("df"), F.round(F.sqrt(chi2 / F.max("tn")), 8).alias("cramer_v"))


def normal_tail(z: Column) -> Column:
    """The chance of a normal variable beyond |z| on either side, by a polynomial in 1 / (1 + 0.2316419 |z|) that is right to 1e-7."""
    x = F.abs(z)
    k = 1.0 / (1.0 + 0.2316419 * x)
    poly = k * (0.319381530 + k * (-0.356563782 + k * (1.781477937 + k * (-1.821255978 + k * 1.330274429))))
    return 2.0 * F.exp(-x * x / 2.0) / math.sqrt(2.0 * math.pi) * poly


@query("ml17_z_tests", f"WITH {S}, g AS (SELECT channel, count(*)::DOUBLE AS n, sum(y)::DOUBLE AS k FROM s GROUP BY 1), x AS (SELECT *, sum(n) OVER ()-n AS n0, sum(k) OVER ()-k AS k0, sum(k) OVER ()/sum(n) OVER () AS pp FROM g), z AS (SELECT channel, (k/n-k0/n0)/sqrt(pp*(1-pp)*(1/n+1/n0)) AS z FROM x), p AS (SELECT channel, z, 1/(1+0.2316419*abs(z)) AS q FROM z), v AS (SELECT channel, z, 2*exp(-z*z/2)/sqrt(2*pi())*q*(0.319381530+q*(-0.356563782+q*(1.781477937+q*(-1.821255978+q*1.330274429)))) AS p FROM p), r AS (SELECT *, row_number() OVER (ORDER BY p, channel) AS i, count(*) OVER () AS m FROM v) SELECT channel, round(z,6) AS z, round(p,6) AS p, round(least(1.0, max((m-i+1)*p) OVER (ORDER BY i)),6) AS p_holm FROM r")
def ml17_z(t: Tables) -> DataFrame:
    """Each channel's rate against that of all others, with Holm's correction. One row a channel in the windows."""
    g = scored_leads(t).groupBy("channel").agg(F.count("*").cast("double").alias("n"), F.sum("y").cast("double").alias("k"))
    x = g.crossJoin(F.broadcast(g.agg(F.sum("n").alias("tn"), F.sum("k").alias("tk"))))
    n, k, n0, k0, pp = F.col("n"), F.col("k"), F.col("tn") - F.col("n"), F.col("tk") - F.col("k"), F.col("tk") / F.col("tn")
    z = x.select("channel", ((k / n - k0 / n0) / F.sqrt(pp * (1 - pp) * (1 / n + 1 / n0))).alias("z")).withColumn("p", normal_tail(F.col("z")))
    order = Window.orderBy("p", "channel")
    r = z.withColumns({"i": F.row_number().over(order), "m": F.count("*").over(Window.partitionBy())})
    return r.select("channel", F.round("z", 6).alias("z"), F.round("p", 6).alias("p"), F.round(F.least(F.lit(1.0), F.max((F.col("m") - F.col("i") + 1) * F.col("p")).over(Window.orderBy("i"))), 6).alias("p_holm"))


@query("ml18_poisson_counts")
def ml18(t: Tables) -> DataFrame:
    rows = models.assembled(project_months(t).withColumn("sales", F.col("sales").cast("double")), ["n_lines"])
    model = GeneralizedLinearRegression(family="poisson", link="log", labelCol="sales", maxIter=25).fit(rows)
    return t.spark.range(1).select(F.lit(float(model.intercept)).alias("intercept"), F.lit(float(model.coefficients[0])).alias("slope"), F.lit(float(model.summary.deviance)).alias("deviance"))


@query("ml19_censored_duration")
def ml19(t: Tables) -> DataFrame:
    s = lead_conversions(t).where("d < '2001-06-01'").withColumns({"event": F.col("days").isNotNull().cast("double"), "label": F.greatest(F.lit(1.0), F.coalesce("days", F.datediff(F.lit("2001-10-01").cast("date"), "d")).cast("double"))})
    model = AFTSurvivalRegression(censorCol="event", maxIter=20).fit(models.assembled(s.withColumn("k", F.col("amount") / 1e5), ["k"]))
    return s.groupBy("channel").agg(F.count("*").alias("n"), F.avg("event").alias("events")).withColumns({"coefficient": F.lit(float(model.coefficients[0])), "scale": F.lit(float(model.scale))})


@query("ml19_kaplan_meier", f"WITH {LC}, s AS (SELECT channel, days IS NOT NULL AS event, CAST(greatest(1, coalesce(days, date_diff('day', d, DATE '2001-10-01'))) AS INTEGER) AS day FROM lc WHERE d<DATE '2001-06-01'), g AS (SELECT channel, day, count(*) AS n, count(*) FILTER (event) AS events FROM s GROUP BY 1,2), r AS (SELECT *, sum(n) OVER (PARTITION BY channel ORDER BY day ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS at_risk FROM g) SELECT channel, day, CAST(at_risk AS BIGINT) AS at_risk, events, round(exp(sum(CASE WHEN events<at_risk THEN ln(1-events/CAST(at_risk AS DOUBLE)) ELSE -1000 END) OVER (PARTITION BY channel ORDER BY day)),8) AS survival FROM r")
def ml19_km(t: Tables) -> DataFrame:
    """The share of leads not yet converted after so many days, leads without conversion counting up to the cut: a running product of a row a day."""
    day = F.greatest(F.lit(1), F.coalesce("days", F.datediff(F.lit("2001-10-01").cast("date"), "d"))).cast("int")
    g = lead_conversions(t).where("d < '2001-06-01'").groupBy("channel", day.alias("day")).agg(F.count("*").alias("n"), F.count("days").alias("events"))
    w = Window.partitionBy("channel").orderBy("day")
    r = g.withColumn("at_risk", F.sum("n").over(w.rowsBetween(0, Window.unboundedFollowing)))
    left = F.when(F.col("events") < F.col("at_risk"), F.log(1 - F.col("events") / F.col("at_risk"))).otherwise(-1000.0)
    return r.select("channel", "day", "at_risk", "events", F.round(F.exp(F.sum(left).over(w.rowsBetween(Window.unboundedPreceding, 0))), 8).alias("survival"))


@query("ml20_rdd")
def ml20(t: Tables) -> DataFrame:
    s = scored_leads(t).withColumn("x", (F.col("amount") - 100000) / 1e4).where("abs(x) <= 5").withColumns({"over": (F.col("x") >= 0).cast("double"), "label": F.col("y").cast("double")}).withColumn("slope", F.col("over") * F.col("x"))
    model = LinearRegression(solver="normal").fit(models.assembled(s, ["over", "x", "slope"]))
    return s.agg(F.count("*").alias("n"), F.lit(float(model.coefficients[0])).alias("jump"), F.lit(float(model.summary.coefficientStandardErrors[0])).alias("se"))


@query("ml21_synthetic_control")
def ml21(t: Tables, treated: int = 0, date: str = "2000-01-01") -> DataFrame:
    """The treated project's months as a weighted sum of all other projects."""
    weights = models.synthetic_weights(project_months(t), treated, date)
    return project_months(t).join(F.broadcast(weights), "project").groupBy("month").agg(F.sum(F.col("sales") * F.col("weight")).alias("synthetic"))


@query("ml22_t_learner")
def ml22(t: Tables) -> DataFrame:
    s = written(scored_leads(t).select("lead", "seller", "amount", "y", (F.col("channel") == "BUILDING").cast("int").alias("treated")), "leads")
    arms = [models.balanced_logistic(s.where(F.col("treated") == k), "y", ["amount"], ["seller"]) for k in (1, 0)]
    keep = ["lead", "seller", "amount", "y"]
    a = models.probability(arms[0], s.select(*keep)).select(*keep, F.col("p").alias("p1"))
    lift = written(models.probability(arms[1], a).select("seller", (F.col("p1") - F.col("p")).alias("uplift")), "uplift")
    return grouped_quantiles(lift, "seller", "uplift", [0.1, 0.5, 0.9], "q")


@query("ml23_role_inference", " UNION ALL ".join(f"SELECT '{c}' AS column_name, CASE WHEN {numeric} AND count(DISTINCT {c})>0.9*count(*) THEN 'id' WHEN {numeric} THEN 'numeric' WHEN count(DISTINCT {c})<0.2*count(*) THEN 'categorical' ELSE 'text' END AS role FROM customer" for c, numeric in (("c_custkey", "TRUE"), ("c_name", "FALSE"), ("c_nationkey", "TRUE"), ("c_mktsegment", "FALSE"))))
def ml23(t: Tables) -> DataFrame:
    """Distinct counts are approximate; the thresholds are far from where they blur."""
    names = ("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    one = t.customer.agg(F.count("*").alias("n"), *(F.approx_count_distinct(c, 0.02).alias(c) for c in names))
    number = {c: t.customer.schema[c].dataType.simpleString() in ("bigint", "int", "double") for c in names}
    role = lambda c: first_of((F.lit(number[c]) & (F.col(c) > 0.9 * F.col("n")), "id"), (F.lit(number[c]), "numeric"), (F.col(c) < 0.2 * F.col("n"), "categorical"), otherwise="text")
    return one.select(F.inline(F.array(*(F.struct(F.lit(c).alias("column_name"), role(c).alias("role")) for c in names))))


@query("ml24_correlation_matrix", "SELECT round(corr(l_quantity,l_extendedprice),6) AS qty_price, round(corr(l_quantity,l_discount),6) AS qty_discount, round(corr(l_extendedprice,l_discount),6) AS price_discount FROM lineitem")
def ml24(t: Tables) -> DataFrame:
    m = Correlation.corr(models.assembled(t.lineitem, ["l_quantity", "l_extendedprice", "l_discount"]), "features").select(F.col("pearson(features)").alias("m")).first()["m"].toArray()
    return t.spark.createDataFrame([(float(m[0, 1]), float(m[0, 2]), float(m[1, 2]))], "a double, b double, c double").select(*(F.round(c, 6).alias(n) for c, n in (("a", "qty_price"), ("b", "qty_discount"), ("c", "price_discount"))))


@query("ml25_auto_baseline")
def ml25(t: Tables) -> DataFrame:
    """metric, value of a first model for whether a lead converts."""
    return models.auto_baseline(scored_leads(t).drop("days", "converted"), "y", "d", "1999-01-01")


@query("ml25_auto_regression")
def ml25_regression(t: Tables) -> DataFrame:
    """metric, value of a first model for the amount of a lead."""
    return models.auto_baseline(scored_leads(t).drop("days", "converted"), "amount", "d", "1999-01-01")


@query("ml26_lift_by_decile", f"WITH {S}, r AS (SELECT y, ntile(10) OVER (PARTITION BY project ORDER BY (lead*7919)%1000 DESC, lead) AS decile FROM s) SELECT CAST(decile AS INTEGER) AS decile, count(*) AS n, round(avg(y),8) AS rate FROM r GROUP BY 1")
def ml26(t: Tables) -> DataFrame:
    s = scored_leads(t).withColumn("score", F.col("lead") * 7919 % 1000)
    return models.lift_by_decile(s, "score", "y", "lead", "project").withColumn("rate", F.round("rate", 8))


def scaled_parts(t: Tables) -> DataFrame:
    raw = models.assembled(t.part, ["p_size", "p_retailprice"]).withColumnRenamed("features", "raw")
    return RobustScaler(inputCol="raw", outputCol="features", withCentering=True).fit(raw).transform(raw)


@query("ml27_kmeans_segments")
def ml27(t: Tables) -> DataFrame:
    rows = scaled_parts(t)
    fit = KMeans(k=3, seed=7).fit(rows)
    return fit.transform(rows).groupBy(F.col("prediction").alias("segment")).agg(F.count("*").alias("n"), F.percentile_approx("p_size", 0.5, 10_000).alias("size"), F.percentile_approx("p_retailprice", 0.5, 10_000).alias("price")).withColumn("inertia", F.lit(float(fit.summary.trainingCost)))


@query("ml27_inertia_curve")
def ml27_curve(t: Tables) -> DataFrame:
    """How much is left within clusters for each number of them."""
    rows = scaled_parts(t)
    return t.spark.createDataFrame([(k, float(KMeans(k=k, seed=7).fit(rows).summary.trainingCost)) for k in range(2, 7)], "k int, inertia double")


@query("ml28_anomaly_score", "WITH m AS (SELECT quantile_cont(o_totalprice,0.5) AS med FROM orders), d AS (SELECT quantile_cont(abs(o_totalprice-med),0.5) AS mad, any_value(med) AS med FROM orders, m) SELECT o_orderkey, round(0.6745*abs(o_totalprice-med)/nullif(mad,0),6) AS score FROM orders, d WHERE 0.6745*abs(o_totalprice-med)/nullif(mad,0)>1.3")
def ml28(t: Tables) -> DataFrame:
    """Robust z from the exact median and median deviation."""
    median = lambda df, c: exact_quantiles(df, [c], [0.5])[c, 0.5]
    away = t.orders.withColumn("away", F.abs(F.col("o_totalprice") - F.lit(median(t.orders, "o_totalprice"))))
    score = 0.6745 * F.col("away") / F.nullif(F.lit(median(away, "away")).cast("double"), F.lit(0.0))
    return away.where(score > 1.3).select("o_orderkey", F.round(score, 6).alias("score"))


@query("ml28_contamination", "WITH m AS (SELECT quantile_disc(l_extendedprice,0.5) AS a, quantile_disc(l_quantity,0.5) AS b FROM lineitem), d AS (SELECT quantile_disc(abs(l_extendedprice-a),0.5) AS da, quantile_disc(abs(l_quantity-b),0.5) AS db, any_value(a) AS a, any_value(b) AS b FROM lineitem, m), s AS (SELECT l_orderkey, l_linenumber, l_partkey, 0.6745*greatest(abs(l_extendedprice-a)/nullif(da,0), abs(l_quantity-b)/nullif(db,0)) AS score FROM lineitem, d), c AS (SELECT quantile_disc(score,0.99) AS cut FROM s) SELECT l_orderkey, l_linenumber, l_partkey, round(score,6) AS score FROM s, c WHERE score>cut")
def ml28_contamination(t: Tables, contamination: float = 0.01) -> DataFrame:
    """The share of lines with the largest robust z of price or quantity. Quantiles are exact."""
    scored = models.robust_scores(t.lineitem, ["l_extendedprice", "l_quantity"])
    cut = discrete_quantiles(scored, ["score"], 1 - contamination)["score"]
    return scored.where(F.col("score") > F.lit(cut).cast("double")).select("l_orderkey", "l_linenumber", "l_partkey", F.round("score", 6).alias("score"))


@query("ml29_permutation_importance")
def ml29(t: Tables) -> DataFrame:
    """The Brier score once a column is dealt anew among the rows of a project, less the plain one."""
    s = scored_leads(t)
    model = models.balanced_logistic(s, "y", ["amount"], ["channel"])
    a, b = Window.partitionBy("project").orderBy("lead"), Window.partitionBy("project").orderBy(F.xxhash64("lead"), "lead")
    other = s.withColumn("i", F.row_number().over(b)).select("project", "i", F.col("amount").alias("amount2"), F.col("channel").alias("channel2"))
    both = s.withColumn("i", F.row_number().over(a)).join(other, ["project", "i"])
    brier = lambda df, name: models.probability(model, df).agg(F.lit(name).alias("feature"), F.avg((F.col("p") - F.col("y")) ** 2).alias("brier"))
    return brier(s, "none").unionByName(brier(both.withColumn("amount", F.col("amount2")), "amount")).unionByName(brier(both.withColumn("channel", F.col("channel2")), "channel"))


@query("ml30_pilot_monitor", f"WITH {S}, g AS (SELECT count(*) FILTER (lead%2=0)::DOUBLE AS nt, count(*) FILTER (lead%2=1)::DOUBLE AS nc, avg(y) FILTER (lead%2=0) AS pt, avg(y) FILTER (lead%2=1) AS pc FROM s) SELECT round(nt/(nt+nc)-0.5,8) AS imbalance, round(pt-pc,8) AS itt, round(pt-pc-1.96*sqrt(pt*(1-pt)/nt+pc*(1-pc)/nc),8) AS low, round(pt-pc+1.96*sqrt(pt*(1-pt)/nt+pc*(1-pc)/nc),8) AS high, round(2*pow(1.96+0.8416,2)*pc*(1-pc)/pow(0.05,2),4) AS needed FROM g")
def ml30(t: Tables) -> DataFrame:
    even = F.col("lead") % 2 == 0
    g = scored_leads(t).agg(F.count_if(even).cast("double").alias("nt"), F.count_if(~even).cast("double").alias("nc"), F.avg(F.when(even, F.col("y"))).alias("pt"), F.avg(F.when(~even, F.col("y"))).alias("pc"))
    nt, nc, pt, pc = map(F.col, ("nt", "nc", "pt", "pc"))
    half = 1.96 * F.sqrt(pt * (1 - pt) / nt + pc * (1 - pc) / nc)
    return g.select(F.round(nt / (nt + nc) - 0.5, 8).alias("imbalance"), F.round(pt - pc, 8).alias("itt"), F.round(pt - pc - half, 8).alias("low"), F.round(pt - pc + half, 8).alias("high"), F.round(2 * (1.96 + 0.8416) ** 2 * pc * (1 - pc) / 0.05**2, 4).alias("needed"))


@query("ml31_scenario_grid", f"WITH {PM}, b AS (SELECT project, CAST(sum(sales) AS DOUBLE) AS base FROM pm GROUP BY 1) SELECT project, dd, dp, round(base*(1+dd)*(1-1.2*dp),4) AS units FROM b CROSS JOIN (VALUES (-0.1::DOUBLE),(0.0),(0.1)) x(dd) CROSS JOIN (VALUES (-0.05::DOUBLE),(0.0),(0.05)) y(dp)")
def ml31(t: Tables) -> DataFrame:
    grid = t.spark.createDataFrame([(a, b) for a in (-0.1, 0.0, 0.1) for b in (-0.05, 0.0, 0.05)], "dd double, dp double")
    b = project_months(t).groupBy("project").agg(F.sum("sales").cast("double").alias("base"))
    return b.crossJoin(F.broadcast(grid)).select("project", "dd", "dp", F.round(F.col("base") * (1 + F.col("dd")) * (1 - 1.2 * F.col("dp")), 4).alias("units"))
