"""Dataset metadata: catalogue records and contacts from project XML."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quadspark.functions.scalars import encode_for_uri, iri
from quadspark.functions.terms import (
    IRI,
    QUAD_COLUMNS,
    RDF_TYPE,
    RDFS,
    Term,
    iri_term,
    literal_term,
    null,
)
from quadspark.functions.xml import field_text, list_schema, nodes_at, xml_parse
from quadspark.operators.patterns import bind, construct, lateral, union
from quadspark.sources.manifest import graph_name

# Vocabulary namespaces of the metadata graph.
DCAT = "http://www.w3.org/ns/dcat#"
PROV = "http://www.w3.org/ns/prov#"
FOAF = "http://xmlns.com/foaf/0.1/"
ORG = "http://www.w3.org/ns/org#"
DCT = "http://purl.org/dc/terms/"
EG = "http://www.example.org/"


def dcat_records(manifest: DataFrame) -> DataFrame:
    """Dataset, distribution, activity and plan triples of each manifest row.

    The manifest has ``group``, ``artifact``, ``version`` and ``type``.
    """
    empty = F.lit("")
    base = graph_name(F.col("group"), F.col("artifact"), F.col("version"), empty, empty)
    data = F.concat_ws(":", base, F.col("type"))

    def suffixed(col: Column, suffix: str) -> Column:
        return F.concat(col, F.lit(suffix))

    named = manifest.select(
        suffixed(base, "#dataset").alias("dataset"), suffixed(base, ":pom").alias("source"), data.alias("file"),
        *(suffixed(data, f"#{x}").alias(x) for x in ("distribution", "activity", "plan")))
    rows = [
        ("dataset", RDF_TYPE, F.lit(DCAT + "Dataset")),
        ("dataset", PROV + "wasGeneratedBy", F.col("activity")),
        ("dataset", DCAT + "distribution", F.col("distribution")),
        ("distribution", DCAT + "downloadURL", F.col("file")),
        ("activity", PROV + "hadPlan", F.col("plan")),
        ("plan", RDF_TYPE, F.lit(EG + "MavenBuild")),
        ("plan", EG + "urn", F.col("source")),
    ]
    structs = [F.struct(F.col(s).alias("s"), F.lit(p).alias("p"), o.alias("o")) for s, p, o in rows]
    triples = named.select(F.inline(F.array(*structs)))
    return triples.select(
        "s", F.lit(IRI).alias("s_kind"), "p", "o", F.lit(IRI).alias("o_kind"),
        null().alias("o_dt"), null().alias("o_lang"), null().alias("g"),
    ).select(*QUAD_COLUMNS).dropDuplicates()


_LICENSES = ("licenses", "license")
_DEVELOPERS = ("developers", "developer")
_DEVELOPER_FIELDS = ("name", "url", "organization", "organizationUrl")


def xml_contacts(docs: DataFrame, base: Column, dataset: Column) -> DataFrame:
    """Licence, contributor, name, organisation, label and website triples from
    the ``xml`` column of project documents.  ``base`` and ``dataset`` are IRIs
    per document.  Each document is parsed once.
    """
    schema = list_schema(_LICENSES, ["url"])[len("struct<"):-1] + ", " + \
        list_schema(_DEVELOPERS, _DEVELOPER_FIELDS)[len("struct<"):-1]
    parsed = docs.select(
        xml_parse(F.col("xml"), f"struct<{schema}>").alias("doc"), base.alias("base"), dataset.alias("dataset"))

    licences = parsed.select("dataset", F.explode(nodes_at(F.col("doc"), _LICENSES)).alias("lic"))
    licence = lateral(licences, [_triple(
        iri_term(F.col("dataset")), DCT + "license", iri(field_text("lic", "url")))])

    people = parsed.select("dataset", "base", F.explode(nodes_at(F.col("doc"), _DEVELOPERS)).alias("dev"))
    for name, field in zip(("dev_name", "dev_url", "org_name", "org_url"), _DEVELOPER_FIELDS, strict=True):
        people = people.withColumn(name, field_text("dev", field))
    dev = _minted("dev/", F.coalesce("dev_url", "dev_name"))
    people = bind(people, "dev_id", dev)
    org_url = iri(F.col("org_url"))
    people = bind(people, "org_id", _minted("org/", F.coalesce(org_url.value, F.col("org_name"))))
    dev_id, org_id = (Term(F.col(v), F.col(f"{v}_kind"), null(), null()) for v in ("dev_id", "org_id"))
    contact = lateral(people, [
        _triple(iri_term(F.col("dataset")), DCAT + "contributor", dev_id),
        _triple(dev_id, FOAF + "name", literal_term(F.col("dev_name"))),
        _triple(dev_id, ORG + "memberOf", org_id),
        _triple(org_id, RDFS + "label", literal_term(F.col("org_name"))),
        _triple(org_id, EG + "website", org_url),
    ])
    terms = [c for v in ("s", "p", "o") for c in (v, v + "_kind", v + "_dt", v + "_lang")]
    return construct(union(licence.select(*terms), contact.select(*terms)), [("?s", "?p", "?o")])


def _triple(s: Term, p: str, o: Term) -> dict[str, Term]:
    return {"s": s, "p": iri_term(F.lit(p)), "o": o}


def _minted(path: str, name: Column) -> Term:
    return iri(F.concat(F.col("base"), F.lit(path), encode_for_uri(name)))
