"""The rule set that turns a row of evidence into scores, as data.

A layer is an ordered list of rules; the first whose condition holds gives the row's
(blocked, down, ok) triple, its rule id and how much evidence stands behind it. Conditions are SQL text
over the columns that :func:`netquill.operators.verdicts.with_flags` makes. A NULL condition does not
hold, so a comparison with missing data falls through to the next rule.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

VERSION = 2


@dataclass(frozen=True)
class Rule:
    id: str
    when: str
    blocked: float
    down: float
    ok: float
    evidence: int
    outcome: str


_SYSTEM = "dns_engine IN ('system', 'getaddrinfo')"
_FAILED = "{layer}_failure IS NOT NULL"
_DNS_DOUBT = "dns_blocked > 0 AND dns_ok <= dns_blocked + dns_down"
_TLS_CTRL_OK = "tls_failure IS NOT NULL AND ctrl_tls_success_rate > 0.5 AND ctrl_tls_success_count > 0"

# Rule ids, triples and evidence levels.
RULES: dict[str, list[Rule]] = {
    "dns": [
        Rule("no_dns_data", "dns_answer_count = 0 AND dns_failure IS NULL", 0, 0, 0, 0, "unknown"),
        Rule("country_consistent_blockpage", "dns_blocking_country_consistent", 1, 0, 0, 2, "blocked"),
        Rule("tls_consistent_answer", "dns_tls_consistent", 0, 0, 1, 2, "ok"),
        Rule("bogon_not_in_ctrl", "dns_answers_contain_bogon = 1 AND NOT dns_answer_matches_ctrl", 0.95, 0.05, 0, 2, "blocked"),
        Rule("bogon_in_ctrl", "dns_answers_contain_bogon = 1 AND dns_answer_matches_ctrl", 0.1, 0.9, 0, 2, "down"),
        Rule("tls_inconsistent_not_in_ctrl", "dns_tls_inconsistent AND NOT dns_answer_matches_ctrl", 0.9, 0.05, 0.05, 2, "blocked"),
        Rule("answer_matches_ctrl", "dns_answer_matches_ctrl", 0, 0, 0.9, 2, "ok"),
        Rule("answer_asn_matches_ctrl", "dns_answer_asn_matches_ctrl", 0.2, 0, 0.8, 2, "ok"),
        Rule("dns_system_failure_ctrl_also_failing", f"{_SYSTEM} AND dns_failure IS NOT NULL AND ctrl_dns_success_rate <= 0.5", 0.1, 0.9, 0, 2, "down"),
        Rule("dns_system_failure_ctrl_ok", f"{_SYSTEM} AND dns_failure IS NOT NULL AND ctrl_dns_success_rate > 0.5", 0.9, 0.1, 0, 2, "blocked"),
        Rule("dns_system_failure_no_ctrl", f"{_SYSTEM} AND dns_failure IS NOT NULL", 0.5, 0.5, 0, 2, "unknown"),
        Rule("dns_system_answer_unmatched", f"{_SYSTEM} AND dns_failure IS NULL", 0.75, 0, 0.25, 2, "blocked"),
    ],
    "tcp": [
        Rule("no_tcp_data", "tcp_success <> 1 AND tcp_failure IS NULL", 0, 0, 0, 0, "unknown"),
        Rule("connect_ok", "tcp_failure IS NULL AND tcp_success = 1", 0, 0, 1, 2, "ok"),
        Rule("ipv6_broken_probe", "tcp_failure IS NOT NULL AND ip_is_v6 AND tcp_ipv6_failure_rate > 0.5", 0, 0, 0, 1, "unknown"),
        Rule("failure_ctrl_ok", "tcp_failure IS NOT NULL AND ctrl_tcp_success_rate > 0.5 AND ctrl_tcp_success_count > 0", 0.75, 0.25, 0, 2, "blocked"),
        Rule("dns_untrusted", _DNS_DOUBT, 0, 0, 0, 1, "unknown"),
        Rule("failure_ctrl_also_failing", "tcp_failure IS NOT NULL AND ctrl_tcp_success_rate <= 0.5 AND ctrl_tcp_failing_count > 0", 0.25, 0.75, 0, 2, "down"),
    ],
    "tls": [
        Rule("no_tls_data", "tls_is_certificate_valid IS NULL AND tls_failure IS NULL", 0, 0, 0, 0, "unknown"),
        Rule("certificate_valid", "tls_is_certificate_valid = 1", 0, 0, 1, 2, "ok"),
        Rule("failure_ctrl_ok_ssl", f"{_TLS_CTRL_OK} AND startswith(tls_failure, 'ssl_')", 0.9, 0.1, 0, 2, "blocked"),
        Rule("failure_ctrl_ok_reset", f"{_TLS_CTRL_OK} AND tls_failure = 'connection_reset'", 0.8, 0.2, 0, 2, "blocked"),
        Rule("failure_ctrl_ok_other", _TLS_CTRL_OK, 0.7, 0.3, 0, 2, "blocked"),
        Rule("dns_untrusted", _DNS_DOUBT, 0, 0, 0, 1, "unknown"),
        Rule("tcp_blocked", "tcp_blocked > 0 AND tcp_ok <= tcp_blocked + tcp_down", 0, 0, 0, 1, "unknown"),
        Rule("failure_ctrl_also_failing", "tls_failure IS NOT NULL AND ctrl_tls_success_rate <= 0.5 AND ctrl_tls_failing_count > 0", 0.2, 0.8, 0, 2, "down"),
    ],
}
NONE = Rule("none", "true", 0, 0, 0, 0, "unknown")


def compile_rules(layer: str, rules: list[Rule] | None = None) -> Column:
    """One ``when`` chain: struct(rule_id, blocked, down, ok, evidence) of the first rule that holds."""
    chain = None
    value = lambda r: F.struct(
        F.lit(r.id).alias("rule_id"),
        *[F.lit(float(x)).alias(n) for n, x in (("blocked", r.blocked), ("down", r.down), ("ok", r.ok))],
        F.lit(r.evidence).alias("evidence"),
    )
    for r in RULES[layer] if rules is None else rules:
        chain = (F if chain is None else chain).when(F.expr(r.when), value(r))
    return chain.otherwise(value(NONE))


def score_layers(rows: DataFrame) -> DataFrame:
    """Score DNS, then TCP, then TLS: later layers read the scores of earlier ones."""
    for layer in ("dns", "tcp", "tls"):
        rows = rows.withColumn("_s", compile_rules(layer))
        names = {"rule_id": f"{layer}_rule_id", "blocked": f"{layer}_blocked", "down": f"{layer}_down", "ok": f"{layer}_ok", "evidence": f"{layer}_evidence"}
        rows = rows.select("*", *[F.col(f"_s.{a}").alias(b) for a, b in names.items()]).drop("_s")
    return rows


def rule_table(spark: SparkSession) -> DataFrame:
    """(layer, rule_id, position, outcome, evidence, blocked, down, ok, version) of every rule."""
    rows = [
        (layer, r.id, i, r.outcome, r.evidence, float(r.blocked), float(r.down), float(r.ok), VERSION)
        for layer, rules in RULES.items()
        for i, r in enumerate([*rules, NONE])
    ]
    return spark.createDataFrame(
        rows, "layer string, rule_id string, position int, outcome string, evidence int, blocked double, down double, ok double, version int"
    )


def reweight(verdicts: DataFrame, rules: DataFrame, layer: str) -> DataFrame:
    """Scores of one layer from the stored rule ids and another table of weights, without rescoring."""
    weights = rules.filter(F.col("layer") == layer).select(
        F.col("rule_id").alias(f"top_{layer}_rule_id"),
        *[F.col(c).alias(f"{layer}_{c}_new") for c in ("blocked", "down", "ok")],
    )
    # the rule table has one row a rule: a few dozen
    return verdicts.join(F.broadcast(weights), f"top_{layer}_rule_id", "left")


def lint(rules: DataFrame) -> DataFrame:
    """(layer, problem, rule_id) for each rule that breaks an invariant of a rule set."""
    total = F.col("blocked") + F.col("down") + F.col("ok")
    bad = lambda cond, name: rules.filter(cond).select("layer", F.lit(name).alias("problem"), "rule_id")
    twice = rules.groupBy("layer", "rule_id").agg(F.count("*").alias("n")).filter("n > 1")
    last = rules.groupBy("layer").agg(F.max_by("rule_id", "position").alias("rule_id")).filter("rule_id <> 'none'")
    return (
        twice.select("layer", F.lit("repeated id").alias("problem"), "rule_id")
        .unionByName(bad(F.least("blocked", "down", "ok") < 0, "negative weight"))
        .unionByName(bad(total > 1.000001, "weights exceed one"))
        .unionByName(bad((F.col("evidence") < 2) & (total > 0), "scores without evidence"))
        .unionByName(bad((F.col("evidence") == 2) & (total <= 0), "evidence without scores"))
        .unionByName(last.select("layer", F.lit("no catch-all at the end").alias("problem"), "rule_id"))
    )
