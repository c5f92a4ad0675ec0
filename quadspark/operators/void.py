"""Dataset statistics.

The input is a quad DataFrame or a ``MappedGraph``.  It is a set of triples; apply ``graphs.as_set`` first to
rows that may repeat.  Distinct counts compare whole terms.  Spark counts
distinct values in two levels, first by (group, value), so that a dominant class
or predicate is spread over all tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quadspark.functions.terms import (
    BNODE,
    IRI,
    LITERAL,
    QUAD_COLUMNS,
    RDF,
    RDF_TYPE,
    XSD_INTEGER,
    null,
    term_key,
)
from quadspark.operators.graphs import set_digest

VOID = "http://rdfs.org/ns/void#"


def _quads(graph, only=None) -> DataFrame:
    """Rows of a DataFrame or a ``MappedGraph``; the latter maps only the predicates asked for."""
    return graph.quads(only) if hasattr(graph, "quads") else graph


def _count(name: str):
    return F.count(F.lit(1)).alias(name)


def void_dataset(graph, approx: bool = False) -> DataFrame:
    """Triples, distinct subjects, properties and distinct objects."""
    quads = _quads(graph)
    if approx:
        return quads.agg(
            _count("triples"),
            F.approx_count_distinct("s").alias("distinct_subjects"),
            F.approx_count_distinct("p").alias("properties"),
            F.approx_count_distinct(term_key("o")).alias("distinct_objects"),
        )
    return quads.agg(
        _count("triples"),
        F.count_distinct("s").alias("distinct_subjects"),
        F.count_distinct("p").alias("properties"),
        F.count_distinct(term_key("o")).alias("distinct_objects"),
    )


def types(graph) -> DataFrame:
    """Distinct (subject, class) pairs."""
    typed = _quads(graph, {RDF_TYPE}).filter((F.col("p") == RDF_TYPE) & (F.col("o_kind") == IRI))
    pairs = typed.select(F.col("s").alias("inst"), F.col("o").alias("class"))
    # A join adds an exchange of its own behind the distinct, so that hot subjects can be split.
    return pairs.dropDuplicates()


def void_classes(graph) -> DataFrame:
    typed = _quads(graph, {RDF_TYPE}).filter((F.col("p") == RDF_TYPE) & (F.col("o_kind") == IRI))
    return typed.agg(F.count_distinct("o").alias("classes"))


def _typed(graph) -> DataFrame:
    """Triples of typed subjects with each class of the subject."""
    return _quads(graph).join(types(graph), F.col("s") == F.col("inst"))


def class_partition(graph) -> DataFrame:
    """Per class: triples, properties and distinct objects of its instances."""
    return _by_class(_typed(graph))


def class_property_partition(graph) -> DataFrame:
    """Per class and property: triples, distinct subjects and distinct objects."""
    return _by_class_and_property(_typed(graph))


def class_partitions(graph) -> DataFrame:
    """Both class partitions; ``p`` is null in the rows per class.

    Both aggregate the same join with the same columns, so its shuffles are
    written once and reused.
    """
    typed = _typed(graph)
    per_property = _by_class_and_property(typed).withColumn("properties", F.lit(1).cast("bigint"))
    per_class = _by_class(typed).withColumns({"p": null(), "distinct_subjects": F.lit(None).cast("bigint")})
    return per_property.unionByName(per_class)


def class_property_partition_by_subject(graph) -> DataFrame:
    """``class_property_partition`` of a graph whose quads are dealt by subject (``GraphBySubject``).

    Subjects are counted where they are, and only objects are shuffled: no task holds both.
    """
    typed = _typed(graph)
    subjects = typed.groupBy("class", "p", "s").agg(_count("__n")).groupBy("class", "p").agg(
        F.sum("__n").alias("triples"), F.count("s").alias("distinct_subjects"))
    objects = typed.groupBy("class", "p").agg(F.count_distinct(term_key("o")).alias("distinct_objects"))
    return subjects.join(objects, ["class", "p"])


def class_partitions_by_subject(graph) -> DataFrame:
    """``class_partitions`` of a graph whose quads are dealt by subject."""
    per_property = class_property_partition_by_subject(graph)
    sums = per_property.groupBy("class").agg(F.sum("triples").alias("triples"), F.count("p").alias("properties"))
    objects = _typed(graph).groupBy("class").agg(F.count_distinct(term_key("o")).alias("distinct_objects"))
    per_class = sums.join(objects, "class").withColumns({"p": null(), "distinct_subjects": F.lit(None).cast("bigint")})
    return per_property.withColumn("properties", F.lit(1).cast("bigint")).unionByName(per_class)


def _by_class(typed: DataFrame) -> DataFrame:
    return typed.groupBy("class").agg(
        _count("triples"),
        F.count_distinct("p").alias("properties"),
        F.count_distinct(term_key("o")).alias("distinct_objects"),
    )


def _by_class_and_property(typed: DataFrame) -> DataFrame:
    return typed.groupBy("class", "p").agg(
        _count("triples"),
        F.count_distinct("s").alias("distinct_subjects"),
        F.count_distinct(term_key("o")).alias("distinct_objects"),
    )


def class_cooccurrence(graph) -> DataFrame:
    """Per class: distinct classes that its instances have, itself included.

    Subjects with equal class sets are represented by one of them, found by an
    order-free digest of the set, so the self-join runs over the distinct class
    sets and not over the instances.
    """
    pairs = types(graph)
    digests = pairs.groupBy("inst").agg(*set_digest(F.col("class")), F.count(F.lit(1)).alias("__n"))
    keys = [c for c in digests.columns if c != "inst"]
    representatives = digests.groupBy(*keys).agg(F.min("inst").alias("inst")).select("inst")
    sets = pairs.join(representatives, "inst", "left_semi")
    other = sets.select(F.col("inst").alias("inst2"), F.col("class").alias("class2"))
    return (
        sets.join(other, F.col("inst") == F.col("inst2"))
        .groupBy("class").agg(F.count_distinct("class2").alias("classes"))
    )


def class_instances(graph) -> DataFrame:
    """Per class: distinct subjects."""
    typed = _quads(graph, {RDF_TYPE}).filter((F.col("p") == RDF_TYPE) & (F.col("o_kind") == IRI))
    return typed.groupBy(F.col("o").alias("class")).agg(F.count_distinct("s").alias("instances"))


def property_partition(graph) -> DataFrame:
    """Per property: triples, distinct subjects and distinct objects."""
    return _quads(graph).groupBy("p").agg(
        _count("triples"),
        F.count_distinct("s").alias("distinct_subjects"),
        F.count_distinct(term_key("o")).alias("distinct_objects"),
    )


def property_partition_by_subject(quads: DataFrame) -> DataFrame:
    """``property_partition`` of quads whose subjects are each in one task.

    Subjects are counted where they are, and only objects are shuffled.  The quads are asked for twice; a
    shuffle below them is written once and read twice.
    """
    subjects = quads.groupBy("p", "s").agg(_count("__n")).groupBy("p").agg(
        F.sum("__n").alias("triples"), F.count("s").alias("distinct_subjects"))
    objects = quads.groupBy("p").agg(F.count_distinct(term_key("o")).alias("distinct_objects"))
    same = objects.select(F.col("p").alias("__p"), "distinct_objects")
    return subjects.join(same, F.col("p").eqNullSafe(F.col("__p"))).drop("__p")


def node_kind_profile(graph) -> DataFrame:
    """Distinct nodes by kind and place, and distinct literals by datatype and language.

    Rows are ``(measure, key, n)``; ``key`` is the datatype or language tag, else
    empty.  Each node is reduced to one row before anything is counted.
    """
    ends = F.array(
        F.struct(F.lit(1).alias("subj"), F.col("s").alias("v"), F.col("s_kind").alias("kind"),
                 null().alias("dt"), null().alias("lang")),
        F.struct(F.lit(0).alias("subj"), F.col("o").alias("v"), F.col("o_kind").alias("kind"),
                 F.col("o_dt").alias("dt"), F.col("o_lang").alias("lang")),
    )
    nodes = _quads(graph).select(F.inline(ends)).groupBy("v", "kind", "dt", "lang").agg(
        F.max("subj").alias("as_s"), F.min("subj").alias("as_o"),
    )
    in_s, in_o = F.col("as_s") == 1, F.col("as_o") == 0
    is_iri, is_bnode, is_literal = (F.col("kind") == k for k in (IRI, BNODE, LITERAL))

    def measure(cond, name, key=None):
        return F.when(cond, F.struct(F.lit(name).alias("measure"), (F.lit("") if key is None else key).alias("key")))

    measures = F.array_compact(F.array(
        measure(F.lit(True), "distinct_nodes"),
        measure(is_iri, "distinct_iris"),
        measure(is_bnode, "distinct_bnodes"),
        measure(is_literal, "distinct_literals"),
        measure(is_iri & in_s, "iri_subjects"),
        measure(is_bnode & in_s, "bnode_subjects"),
        measure(is_iri & in_o, "iri_objects"),
        measure(is_bnode & in_o, "bnode_objects"),
        measure(is_literal, "literals_by_datatype", F.col("dt")),
        measure(F.col("lang").isNotNull(), "literals_by_language", F.col("lang")),
    ))
    return nodes.select(F.inline(measures)).groupBy("measure", "key").agg(_count("n"))


def partition_iri(dataset_iri: str, kind: str, *keys) -> Column:
    """IRI of a partition node, made from what the partition is about."""
    return F.concat(F.lit(f"{dataset_iri}/void/{kind}-"), F.sha2(F.concat_ws("\u0001", *keys), 256))


# Statistic columns and the vocabulary terms they become (fixed by the VoID vocabulary).
VOID_TERMS = {
    "triples": VOID + "triples",
    "distinct_subjects": VOID + "distinctSubjects",
    "distinct_objects": VOID + "distinctObjects",
    "properties": VOID + "properties",
    "classes": VOID + "classes",
    "instances": VOID + "entities",
}


def void_to_rdf(stats: DataFrame, dataset_iri: str) -> DataFrame:
    """Statistics as triples under the dataset IRI.

    Rows with a ``class`` become class partitions, rows with ``p`` property
    partitions, rows with both a property partition inside the class partition.
    """
    has_class, has_p = "class" in stats.columns, "p" in stats.columns
    subject = F.lit(dataset_iri)
    structs = []

    def add(s, p, o, kind, dt=None):
        structs.append(F.struct(
            s.alias("s"), F.lit(IRI).alias("s_kind"), F.lit(p).alias("p"), o.alias("o"),
            F.lit(kind).alias("o_kind"), (F.lit(dt) if dt else null()).alias("o_dt"), null().alias("o_lang"),
        ))

    if has_class:
        node = partition_iri(dataset_iri, "class", F.col("class"))
        add(subject, VOID + "classPartition", node, IRI)
        add(node, VOID + "class", F.col("class"), IRI)
        subject = node
    if has_p:
        keys = [F.col("class"), F.col("p")] if has_class else [F.col("p")]
        node = partition_iri(dataset_iri, "property", *keys)
        add(subject, VOID + "propertyPartition", node, IRI)
        add(node, VOID + "property", F.col("p"), IRI)
        subject = node
    if not (has_class or has_p):
        add(subject, RDF + "type", F.lit(VOID + "Dataset"), IRI)
    for column, predicate in VOID_TERMS.items():
        if column in stats.columns:
            add(subject, predicate, F.col(column).cast("string"), LITERAL, XSD_INTEGER)
    rows = stats.select(F.inline(F.array(*structs))).filter(F.col("o").isNotNull())
    return rows.withColumn("g", null()).select(*QUAD_COLUMNS).dropDuplicates()
