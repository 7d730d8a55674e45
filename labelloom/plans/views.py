"""Case, part-line, photo and prediction tables derived from the given tables, in Spark and in SQL."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labelloom.functions import softmax
from labelloom.operators.joins import vocabulary
from labelloom.operators.labels import multilabel
from labelloom.session import spread

CLASSES = 10
# All part names of the given tables.
ALL_PARTS = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
# Entries of a vector, and how many runs of CLASSES of them cover all (the last run overlaps the one before).
ENTRIES = 64
EPOCHS = 7


def given_label(case_id: Column, part: Column) -> Column:
    """Label rule, constant per (case, part)."""
    return F.when((case_id * 7 + F.length(part) * 3) % 11 < F.length(part) - 3, 1).otherwise(0)


def per_case(predictions: DataFrame) -> DataFrame:
    """One row per (case, part): mean confidence over views."""
    return predictions.groupBy("case_id", "part").agg(
        F.round(F.avg("conf"), 9).alias("conf"), F.max("gt").alias("gt")
    )


class Views:
    """Lazy views over one folder of tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._tables[name]

    @cached_property
    def parts(self) -> list[str]:
        """The label vocabulary; size-checked."""
        return vocabulary(self.table("part"), "p_type")

    def by_case(self, df: DataFrame) -> DataFrame:
        """A view dealt by its case, so that views with rows per case and part are grouped and joined in small tasks.

        The tables' row counts, which their files name, decide how many tasks; all views are dealt to equally many.
        """
        rows = self.table("lineitem").count() + self.table("orders").count() * len(ALL_PARTS)
        return spread(df, rows, "case_id")

    @property
    def cases(self) -> DataFrame:
        orders, customer = self.table("orders"), self.table("customer")
        return orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
            F.col("o_orderkey").alias("case_id"),
            F.col("o_orderpriority").alias("vehicle_type"),
            F.col("o_orderstatus").alias("claim_type"),
            F.col("o_totalprice").alias("gross_offer"),
            F.col("c_mktsegment").alias("model"),
            (F.col("o_custkey") % 3).cast("int").alias("vehicle_class"),
            F.concat(F.lit("reason "), (F.col("o_orderkey") % 7).cast("string")).alias("circumstances"),
        )

    @property
    def part_lines(self) -> DataFrame:
        lines, part = self.table("lineitem"), self.table("part")
        return lines.join(part, F.col("l_partkey") == F.col("p_partkey")).select(
            F.col("l_orderkey").alias("case_id"),
            F.lower("p_name").alias("description"),
            F.col("l_extendedprice").alias("fval"),
            F.lower("l_returnflag").alias("damage_cond"),
            F.col("p_type").alias("part"),
            F.col("l_linenumber").alias("line"),
            F.col("l_shipdate").alias("ship_date"),
            F.col("l_quantity").alias("quantity"),
        )

    @property
    def files(self) -> DataFrame:
        return self.table("events").select(
            (F.col("user_id") * 100 + F.dayofmonth("ts")).alias("case_id"),
            F.col("event_id").alias("doc_id"),
            F.col("event_type").alias("view"),
            F.col("ts").alias("final_date"),
        )

    @property
    def predictions(self) -> DataFrame:
        lines, part = self.table("lineitem"), self.table("part")
        gt = given_label(F.col("l_orderkey"), F.col("p_type"))
        noise = F.col("l_linenumber") % 3 == 0
        conf = F.when(noise, F.col("l_discount") * 10).otherwise(gt * F.lit(0.6) + F.col("l_discount") * 4)
        return lines.join(part, F.col("l_partkey") == F.col("p_partkey")).select(
            F.col("l_orderkey").alias("case_id"),
            F.col("p_type").alias("part"),
            F.col("l_linenumber").alias("view"),
            F.lit(0.5).alias("threshold"),
            conf.alias("conf"),
            gt.alias("gt"),
        )

    @property
    def case_predictions(self) -> DataFrame:
        """One row per (case, part): mean confidence over views."""
        return per_case(self.predictions)

    @property
    def labels(self) -> DataFrame:
        """`label_grid` spread by case, ready to join.

        The optimiser takes an exploded table to be as small as its input. Behind a shuffle its real
        size is known before a join strategy is chosen, so it is never broadcast by mistake.
        """
        return self.label_grid.repartition("case_id")

    @property
    def labels_by_part(self) -> DataFrame:
        """The same for joins on (case_id, part)."""
        return self.label_grid.repartition("case_id", "part")

    @property
    def label_grid(self) -> DataFrame:
        """(case_id, part, gt) for every case and vocabulary part."""
        names = F.array(*[F.lit(p) for p in self.parts])
        grid = self.table("orders").select(F.col("o_orderkey").alias("case_id"), F.explode(names).alias("part"))
        return grid.withColumn("gt", given_label(F.col("case_id"), F.col("part")))

    @property
    def wide_labels(self) -> DataFrame:
        """0/1 column per vocabulary part, with a model column."""
        orders = self.table("orders")
        case_id = F.col("o_orderkey")
        return orders.select(
            case_id.alias("case_id"),
            F.col("o_orderpriority").alias("model"),
            *[given_label(case_id, F.lit(p)).alias(p) for p in self.parts],
        )

    @property
    def epoch_logits(self) -> DataFrame:
        first = F.least(F.col("epoch") * CLASSES, F.lit(ENTRIES - CLASSES)) + 1
        logits = F.slice("embedding", first, CLASSES).cast("array<double>")
        epochs = self.table("embeddings").select(
            "*", F.explode(F.sequence(F.lit(0), F.lit(EPOCHS - 1))).alias("epoch")
        )
        return epochs.select(F.col("vec_id").alias("sample_id"), "epoch", "label", logits.alias("logits"))

    @property
    def class_probs(self) -> DataFrame:
        """Every class has the sum of each CLASSES-th entry as its logit."""
        def logit(j):
            own = F.transform(F.sequence(j, F.lit(ENTRIES - 1), F.lit(CLASSES)), lambda i: F.get("embedding", i).cast("double"))
            return F.aggregate(own, F.lit(0.0), lambda a, x: a + x)

        logits = F.transform(F.sequence(F.lit(0), F.lit(CLASSES - 1)), logit)
        return self.table("embeddings").select(
            F.col("vec_id").alias("sample_id"),
            "label",
            softmax(logits).alias("probs"),
            (F.col("vec_id") % 2 + 1).alias("dataset_index"),
        )

    @property
    def two_label(self) -> DataFrame:
        return self.table("labels").join(self.table("documents"), "doc_id").select(
            "doc_id", "quality", "toxic", "n_chars", "lang"
        )

    @property
    def observed(self) -> DataFrame:
        """Wide multi-label table of the part lines seen per case."""
        return multilabel(self.part_lines, "case_id", "part", self.parts)

    @property
    def raw_json(self) -> DataFrame:
        """Case documents and file listings as text, one per order; a document holds its order's lines."""
        line = F.struct(
            F.lower("p_name").alias("Description"),
            F.col("l_extendedprice").alias("fVAL"),
            F.lower("l_returnflag").alias("DamageCond"),
            F.col("l_linestatus").alias("CoType"),
        )
        lines = self.table("lineitem")
        joined = lines.join(self.table("part"), F.col("l_partkey") == F.col("p_partkey"))
        parts = joined.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.collect_list(line).alias("parts"))
        docs = self.table("orders").join(parts, "o_orderkey", "left")
        main = F.struct(
            F.col("o_orderkey").alias("CaseID"),
            F.col("o_orderpriority").alias("Vehicle_Type"),
            F.col("o_orderstatus").alias("Claim_Type"),
            F.lit("m").alias("Model"),
            F.col("o_totalprice").alias("Gross_Offer_Insurer"),
        )
        status = F.when(F.col("o_orderkey") % 50 == 0, "ERR").otherwise("OK").alias("status")
        data = F.struct(F.struct(main.alias("main"), F.struct("parts").alias("est_details")).alias("data"))
        file = F.struct(
            F.col("o_orderkey").alias("iDOCID"),
            F.date_format("o_orderdate", "yyyy-MM-dd").alias("FinalDate"),
            F.col("o_orderstatus").alias("StdDocDesc"),
        )
        return docs.select(
            F.to_json(F.struct(status, data.alias("data"))).alias("doc"), F.to_json(F.array(file)).alias("files")
        )


GT_SQL = "case when (case_id * 7 + length(part) * 3) % 11 < length(part) - 3 then 1 else 0 end"

# The same views as common table expressions; `with_views` prepends the ones a statement needs.
VIEW_SQL = {
    "cases": """select o_orderkey as case_id, o_orderpriority as vehicle_type, o_orderstatus as claim_type,
        o_totalprice as gross_offer, c_mktsegment as model, cast(o_custkey % 3 as integer) as vehicle_class,
        'reason ' || cast(o_orderkey % 7 as varchar) as circumstances
        from orders join customer on o_custkey = c_custkey""",
    "part_lines": """select l_orderkey as case_id, lower(p_name) as description, l_extendedprice as fval,
        lower(l_returnflag) as damage_cond, p_type as part, l_linenumber as line, l_shipdate as ship_date,
        l_quantity as quantity from lineitem join part on l_partkey = p_partkey""",
    "files": """select user_id * 100 + day(ts) as case_id, event_id as doc_id, event_type as view,
        ts as final_date from events""",
    "vocab": "select distinct p_type as part from part",
    "graded": f"""select case_id, part, view, discount, {GT_SQL} as gt from
        (select l_orderkey as case_id, p_type as part, l_linenumber as view, l_discount as discount
         from lineitem join part on l_partkey = p_partkey)""",
    "predictions": """select case_id, part, view, cast(0.5 as double) as threshold,
        case when view % 3 = 0 then discount * 10 else cast(0.6 as double) * gt + discount * 4 end as conf, gt
        from graded""",
    "case_predictions": """select case_id, part, round(avg(conf), 9) as conf, max(gt) as gt
        from predictions group by case_id, part""",
    "labels_long": f"""select case_id, part, {GT_SQL} as gt
        from (select o_orderkey as case_id, part from orders cross join vocab)""",
    "votes": """select case_id, part, max(gt) as gt, count(*) as n, round(avg(conf), 9) as conf,
        sum(case when conf > threshold then 1 else 0 end) as pos from predictions group by case_id, part""",
    "decisions": """select l.case_id, l.part, coalesce(v.gt, l.gt) as gt,
        case when v.n is null then 0 when v.pos * 2 > v.n then 1 when v.pos * 2 < v.n then 0
             when v.conf >= 0.5 then 1 else 0 end as pred
        from labels_long l left join votes v on l.case_id = v.case_id and l.part = v.part
        where l.case_id in (select case_id from predictions)""",
    "epoch_logits": """select vec_id as sample_id, e as epoch, label,
        list_transform(list_slice(embedding, least(e * 10, 54) + 1, least(e * 10, 54) + 10), lambda x: cast(x as double)) as logits
        from embeddings, (select cast(unnest(range(7)) as integer) as e)""",
    "softmaxed": """select sample_id, epoch, label, list_transform(ex, lambda x: x / list_sum(ex)) as probs from
        (select *, list_transform(logits, lambda x: exp(x - list_max(logits))) as ex from epoch_logits)""",
    "class_logits": """select vec_id as sample_id, label, list_transform(range(10), lambda j: list_sum(list_transform(range(j, 64, 10),
        lambda i: cast(embedding[i + 1] as double)))) as logits from embeddings""",
    "class_probs": """select sample_id, label, list_transform(ex, lambda x: x / list_sum(ex)) as probs, sample_id % 2 + 1 as dataset_index from
        (select *, list_transform(logits, lambda x: exp(x - list_max(logits))) as ex from class_logits)""",
    "two_label": """select doc_id, quality, toxic, n_chars, lang
        from labels join documents using (doc_id)""",
}


def with_views(sql: str, *names: str, **more: str) -> str:
    """Prefix a statement with the named views, those they build on, and local expressions."""
    needed: list[str] = []

    def need(name: str) -> None:
        body = VIEW_SQL[name]
        for other in VIEW_SQL:
            if other != name and f" {other}" in f" {body}".replace("\n", " ") and _mentions(body, other):
                need(other)
        if name not in needed:
            needed.append(name)

    for name in names:
        need(name)
    parts = [f"{n} as ({VIEW_SQL[n]})" for n in needed] + [f"{n} as ({body})" for n, body in more.items()]
    return f"with {', '.join(parts)} {sql}" if parts else sql


def _mentions(body: str, name: str) -> bool:
    words = body.replace(",", " ").replace("(", " ").replace(")", " ").split()
    return any(a in ("from", "join") and b == name for a, b in zip(words, words[1:]))
