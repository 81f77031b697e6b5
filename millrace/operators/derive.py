"""Registry rows in one universal shape, and what is derived from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.names import ATTORNEY, CORPORATE_AGENT, blank, city_line, join_parts, normalize_address, strip_status
from ..functions.similarity import addresses_match

# Code tables and output columns.
OFFICER_TITLES = {"P": "President", "T": "Treasurer", "C": "Chairman", "V": "Vice President", "S": "Secretary", "D": "Director"}
OFFICER_ORDER = ("P", "D", "C", "V", "T", "S")
CO_TYPES = {"DLLC": "Domestic LLC", "FLLC": "Foreign LLC", "DPC": "Domestic Profit Corp", "FPC": "Foreign Profit Corp", "DNP": "Domestic Nonprofit", "FNP": "Foreign Nonprofit", "DLP": "Domestic LP", "FLP": "Foreign LP", "DLLP": "Domestic LLP", "FLLP": "Foreign LLP"}
UNIVERSAL = ("match_count", "first_result_name", "entity_number", "status", "entity_type", "formation_date", "jurisdiction", "agent_name", "agent_type", "agent_is_individual", "agent_address", "principal_address", "mailing_address", "statement_due_date", "inactive_date", "agent_address_matches_principal", "likely_owner_name", "operator_pattern", "multi_entity_operator", "query_used", "query_attempts", "name_similarity", "score", "alternates", "fetched_at", "error")
EXTRAS = {
    "fl": ("officers_json", "fei_number", "filing_type"),
    "ny": ("county", "ceo_name", "ceo_address", "dos_process_name", "location_address"),
    "co": ("agent_first_name", "agent_middle_name", "agent_last_name", "agent_organization_name"),
    "tx": ("taxpayer_number", "sos_file_number", "right_to_transact", "sos_registration_status", "zip"),
    "ca": ("standing_sos", "standing_ftb", "standing_agent", "standing_vcfcf"),
}
PREFIX = {"fl": "fl_", "ny": "ny_", "co": "co_", "tx": "tx_", "ca": "bf_"}


def universal(df: DataFrame, state: str) -> DataFrame:
    """The universal columns of a state, prefixed, missing ones blank; other columns stay in front."""
    names = [*UNIVERSAL, *EXTRAS[state]]
    own = [c for c in df.columns if c not in names]
    return df.select(*own, *((F.col(n).cast("string") if n in df.columns else F.lit("")).alias(PREFIX[state] + n) for n in names))


def code_label(c: Column, table: dict[str, str]) -> Column:
    """The label of a code, or the code itself."""
    out = c
    for code, label in table.items():
        out = F.when(c == code, label).otherwise(out)
    return out


def true_false(c: Column) -> Column:
    """"True", "False", or blank for null."""
    return F.when(c, "True").when(~c, "False").otherwise("")


def us_date(c: Column) -> Column:
    """yyyy-MM-dd as MM/dd/yyyy; a text that is no date stays."""
    day = F.substring(blank(c), 1, 10)
    return F.coalesce(F.date_format(F.try_to_date(F.when(day != "", day), "yyyy-MM-dd"), "MM/dd/yyyy"), day)


def month_first_date(c: Column) -> Column:
    """MMDDCCYY as MM/DD/CCYY; blank for anything else."""
    return F.when(blank(c).rlike(r"^\d{8}$"), F.regexp_replace(c, r"^(\d{2})(\d{2})(\d{4})$", "$1/$2/$3")).otherwise("")


def any_date(c: Column) -> Column:
    """First of MM/dd/yyyy, yyyy-MM-dd and MM/dd/yy that parses; null if none."""
    t = F.trim(blank(c))
    at = lambda p, f: F.try_to_date(F.when(t.rlike(p), t), f)
    return F.coalesce(at(r"^\d{1,2}/\d{1,2}/\d{4}$", "M/d/yyyy"), at(r"^\d{4}-\d{1,2}-\d{1,2}$", "yyyy-M-d"), at(r"^\d{1,2}/\d{1,2}/\d{2}$", "M/d/yy"))


def _match(agent: Column, principal: Column) -> Column:
    """Whether the addresses match; null if either is blank."""
    return F.when((agent != "") & (principal != ""), addresses_match(agent, principal))


def top_officer(officers: Column) -> Column:
    """Name of the first person by title order, then by place; blank without any."""
    people = F.filter(officers, lambda o: o["type"] == "Person")

    def rank(o: Column) -> Column:
        out = F.lit(99)
        for k, code in enumerate(OFFICER_ORDER, 1):
            out = F.when(o["title_code"] == code, k).otherwise(out)
        return out

    first = F.array_min(F.transform(people, lambda o, i: F.struct(rank(o).alias("r"), i.alias("i"), o["name"].alias("name"))))
    return blank(first["name"])


def florida(df: DataFrame) -> DataFrame:
    """Universal columns of fixed-width records."""
    c = lambda n: blank(F.col(n))
    out = df.withColumns({
        "principal_address": city_line(c("principal_addr_1"), c("principal_addr_2"), c("principal_city"), c("principal_state"), c("principal_zip")),
        "mailing_address": city_line(c("mail_addr_1"), c("mail_addr_2"), c("mail_city"), c("mail_state"), c("mail_zip")),
        "agent_address": city_line(c("agent_addr"), F.lit(""), c("agent_city"), c("agent_state"), c("agent_zip")),
        "likely_owner_name": top_officer(F.col("officers")),
        "individual": c("agent_code") == "P",
        "foreign": c("filing_type").startswith("FOR"),
    })
    pattern = F.when(c("agent_name").rlike(ATTORNEY), "attorney_agent").when(F.col("foreign"), "out_of_state_holdco").when(F.col("likely_owner_name") != "", "owner_operator").when((c("agent_name") != "") & ~F.col("individual"), "service_agent").otherwise("unknown")
    return out.withColumns({
        "first_result_name": c("name"), "entity_type": c("filing_type"), "formation_date": month_first_date(F.col("file_date")),
        "jurisdiction": F.when(F.col("foreign"), "Out-of-state").otherwise("Florida"),
        "agent_type": F.when(F.col("individual"), "Individual").when(c("agent_code") == "C", "Corporation").otherwise(""),
        "agent_is_individual": true_false(F.col("individual")),
        "agent_address_matches_principal": true_false(_match(F.col("agent_address"), F.col("principal_address"))),
        "operator_pattern": pattern,
        "officers_json": F.when(F.size("officers") > 0, F.to_json("officers")).otherwise(""),
    }).drop("individual", "foreign")


def new_york(df: DataFrame) -> DataFrame:
    """Universal columns of active-corporation records."""
    c = lambda n: F.trim(blank(F.col(n)))
    place = lambda p: join_parts(*(F.col(f"{p}_{x}") for x in ("address_1", "address_2", "city", "state", "zip")))
    out = df.withColumns({"ceo_address": place("ceo"), "location_address": place("location"), "process_address": place("dos_process"), "own_agent": place("registered_agent"), "agent_name": F.when(c("registered_agent_name") != "", c("registered_agent_name")).otherwise(c("dos_process_name"))})
    out = out.withColumn("principal_address", F.when(F.col("location_address") != "", F.col("location_address")).otherwise(F.col("process_address"))).withColumn("agent_address", F.when(F.col("own_agent") != "", F.col("own_agent")).otherwise(F.col("process_address")))
    match = F.coalesce(_match(F.col("agent_address"), F.col("principal_address")), F.lit(False))
    person = (c("ceo_name") == "") & (F.col("agent_name") != "") & ~F.col("agent_name").rlike(CORPORATE_AGENT["ny"])
    pattern = F.when(F.col("agent_name").rlike(ATTORNEY), "attorney_agent").when(F.upper(c("entity_type")).contains("FOREIGN"), "out_of_state_holdco").when(c("ceo_name") != "", "owner_operator").when(person & match, "owner_operator").when(person, "individual_agent_offsite").when(F.col("agent_name") != "", "service_agent").otherwise("unknown")
    return out.withColumns({
        "first_result_name": c("current_entity_name"), "entity_number": c("dos_id"), "status": F.lit("Active"), "formation_date": us_date(F.col("initial_dos_filing_date")),
        "mailing_address": F.when(F.col("process_address") != F.col("principal_address"), F.col("process_address")).otherwise(""),
        "agent_type": F.when(person, "Individual").otherwise(""), "agent_is_individual": true_false(person),
        "agent_address_matches_principal": true_false(_match(F.col("agent_address"), F.col("principal_address"))),
        "likely_owner_name": F.when(c("ceo_name") != "", c("ceo_name")).when(person & match, F.col("agent_name")).otherwise(""),
        "operator_pattern": pattern,
    }).drop("process_address", "own_agent")


def colorado(df: DataFrame) -> DataFrame:
    """Universal columns of business-entity records."""
    c = lambda n: F.trim(blank(F.col(n)))
    place = lambda p: join_parts(*(F.col(p + x) for x in ("address1", "address2", "city", "state", "zipcode")))
    who = F.array_join(F.filter(F.array(c("agentfirstname"), c("agentmiddlename"), c("agentlastname"), c("agentsuffix")), lambda p: p != ""), " ")
    out = df.withColumns({"who": who, "principal_address": place("principal"), "mailing_address": place("mailing"), "agent_address": place("agentprincipal")})
    person = (F.col("who") != "") & (c("agentorganizationname") == "")
    out = out.withColumn("person", person).withColumn("agent_name", F.when(F.col("person"), F.col("who")).otherwise(c("agentorganizationname")))
    match = F.coalesce(_match(F.col("agent_address"), F.col("principal_address")), F.lit(False))
    code = F.upper(c("entitytype"))
    owner = F.when(F.col("person") & match, F.col("who")).when(F.col("person") & ~F.col("who").rlike(ATTORNEY), F.concat("who", F.lit(" (offsite agent)"))).otherwise("")
    pattern = F.when(F.col("agent_name").rlike(ATTORNEY), "attorney_agent").when(code.startswith("F"), "out_of_state_holdco").when(F.col("person") & match, "owner_operator").when(F.col("person"), "individual_agent_offsite").when(F.col("agent_name") != "", "service_agent").otherwise("unknown")
    return out.withColumns({
        "first_result_name": strip_status(F.col("entityname")), "entity_number": c("entityid"), "status": c("entitystatus"), "entity_type": code_label(code, CO_TYPES),
        "formation_date": us_date(F.col("entityformdate")), "jurisdiction": c("jurisdictonofformation"),
        "agent_type": F.when(F.col("person"), "Individual").when(c("agentorganizationname") != "", "Corporation").otherwise(""), "agent_is_individual": true_false(F.col("person")),
        "agent_address_matches_principal": true_false(_match(F.col("agent_address"), F.col("principal_address"))),
        "likely_owner_name": owner, "operator_pattern": pattern,
        "agent_first_name": c("agentfirstname"), "agent_middle_name": c("agentmiddlename"), "agent_last_name": c("agentlastname"), "agent_organization_name": c("agentorganizationname"),
    }).drop("who", "person")


def texas(df: DataFrame) -> DataFrame:
    """Derived columns from agent, addresses and jurisdiction of a detail page."""
    c = lambda n: F.trim(blank(F.col(n)))
    principal = F.when(c("principal_address") != "", c("principal_address")).otherwise(c("mailing_address"))
    out = df.withColumn("match_", _match(c("agent_address"), principal)).withColumn("person_", (c("agent_name") != "") & ~c("agent_name").rlike(CORPORATE_AGENT["tx"]))
    match = F.coalesce("match_", F.lit(False))
    owner = F.when(F.col("person_") & match, c("agent_name")).when(F.col("person_") & ~c("agent_name").rlike(ATTORNEY), F.concat(c("agent_name"), F.lit(" (offsite agent)"))).otherwise("")
    pattern = F.when(c("agent_name").rlike(ATTORNEY), "attorney_agent").when(~F.upper(c("jurisdiction")).isin("TX", "TEXAS", ""), "out_of_state_holdco").when(F.col("person_") & match, "owner_operator").when(F.col("person_"), "individual_agent_offsite").when(c("agent_name") != "", "service_agent").otherwise("unknown")
    return out.withColumns({
        "agent_address_matches_principal": true_false(F.col("match_")), "agent_is_individual": true_false(F.col("person_")),
        "agent_type": F.when(F.col("person_"), "Individual").when(c("agent_name") != "", "Corporation").otherwise(""), "likely_owner_name": owner, "operator_pattern": pattern,
    }).drop("match_", "person_")


def california(df: DataFrame) -> DataFrame:
    """Derived columns from agent, addresses and entity type; an owner already there stays if none is derived."""
    c = lambda n: F.trim(blank(F.col(n)))
    out = df.withColumn("match_", _match(c("agent_address"), c("principal_address"))).withColumn("person_", F.lower(c("agent_is_individual")) == "true")
    match = F.coalesce("match_", F.lit(False))
    own = F.col("person_") & (c("agent_name") != "")
    kept = c("likely_owner_name") if "likely_owner_name" in df.columns else F.lit("")
    owner = F.when(own & match, c("agent_name")).when(own & ~c("agent_name").rlike(ATTORNEY), F.concat(c("agent_name"), F.lit(" (no addr match)"))).otherwise(kept)
    pattern = F.when(c("agent_name").rlike(ATTORNEY), "attorney_agent").when((c("agent_name") != "") & ~F.col("person_"), "service_agent").when(F.lower(c("entity_type")).contains("out of state"), "out_of_state_holdco").when(F.col("person_") & match, "owner_operator").when(own, "individual_agent_offsite").otherwise("unknown")
    return out.withColumns({"agent_address_matches_principal": true_false(F.col("match_")), "likely_owner_name": owner, "operator_pattern": pattern}).drop("match_", "person_")


def _times(df: DataFrame, key: str, weight: str | None) -> DataFrame:
    """How often each non-blank key occurs: counted by key, then joined, so a frequent key is no single task."""
    return df.filter(F.col(key) != "").groupBy(key).agg((F.sum(weight) if weight else F.count("*")).alias(key + "n"))


def shared_signals(df: DataFrame, style: str = "flag", weight: str | None = None) -> DataFrame:
    """Add multi_entity_operator from addresses and owners (or, in style "ca", individual agents) that several rows share; a row counts ``weight`` times."""
    agent = F.lower(F.trim(blank(F.col("agent_name"))))
    who = F.when(F.lower(blank(F.col("agent_is_individual"))) == "true", agent).otherwise("") if style == "ca" else F.lower(F.trim(blank(F.col("likely_owner_name"))))
    keyed = df.withColumn("pa_", normalize_address(F.col("principal_address"))).withColumn("who_", who)
    out = keyed.join(_times(keyed, "pa_", weight), "pa_", "left").join(_times(keyed, "who_", weight), "who_", "left")
    many_pa, many_who = F.coalesce(F.col("pa_n") > 1, F.lit(False)), F.coalesce(F.col("who_n") > 1, F.lit(False))
    if style == "ca":
        flag = F.concat_ws("; ", F.when(many_pa, F.concat(F.lit("shared_principal_address:"), "pa_n")), F.when(many_who, F.concat(F.lit("shared_agent:"), "who_n")))
    else:
        flag = F.when(many_pa | many_who, "True").when((F.col("pa_") != "") | (F.col("who_") != ""), "False").otherwise("")
    return out.withColumn("multi_entity_operator", flag).drop("pa_", "who_", "pa_n", "who_n")


def merge_catalogue(seed: DataFrame, new: DataFrame, key: Column, source: str = "new") -> DataFrame:
    """seed plus rows of new whose key the seed lacks, each new key once (first ord), with ``source``."""
    fresh = new.withColumn("k_", key).filter("k_ <> ''").join(seed.select(key.alias("k_")).distinct(), "k_", "left_anti")
    firsts = fresh.groupBy("k_").agg(F.min_by(F.struct(*new.columns), "ord").alias("r")).select("r.*").withColumn("source", F.lit(source))
    return seed.withColumn("source", F.lit("seed")).unionByName(firsts)


def categorise(brands: DataFrame, tags: DataFrame, vocabulary: tuple[str, ...]) -> DataFrame:
    """brands with tags by key; only tags of the vocabulary, ``other`` without any."""
    good = F.filter("tags", lambda t: t.isin(*vocabulary))
    out = brands.join(tags, "key", "left").withColumn("tags", good)
    return out.withColumn("tags", F.when(F.size("tags") > 0, F.col("tags")).otherwise(F.array(F.lit("other"))))


def expand_by_tags(brands: DataFrame, words: list[str], n: int = 20) -> DataFrame:
    """The n brands that share most tags with the words."""
    score = F.size(F.array_intersect("tags", F.array(*map(F.lit, words))))
    return brands.withColumn("score", score).filter("score > 0").orderBy(F.col("score").desc(), "name").limit(n)


def rank_in(df: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in the order."""
    w = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("rn_", F.row_number().over(w)).filter("rn_ = 1").drop("rn_")
