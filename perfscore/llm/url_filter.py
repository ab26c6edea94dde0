"""URL filters: host and path rules, and a logistic regression for all other urls.

The regression reads hashed character n-grams of the host and of the path (digits as
0), each n-gram once.  It is trained by Spark ML on a small labelled table of urls and
scored by adding up a literal table of weights, in built-in expressions only.

Defined results for odd input: a null url, or one without ``://``, has an empty host
and path, fits no rule and gets the model's verdict on no n-grams; repeated rows are
judged each; an empty table gives an empty table; extra columns stay, and columns that
clash with the added ones are replaced.
"""

from __future__ import annotations

import json
import string
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from perfscore.llm.common import let, with_struct

#: Size of the hashed n-gram space, and the lengths of the n-grams.
SPACE = 1 << 14
SIZES = (3, 4, 5)

#: Host and path rules as (verdict, rule); the contract's own.
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"),
         ("allow", "com/fr/"), ("block", "com/de/"))

#: The small labelled table is made from general words: subjects of sites that web filters
#: block, and of sites that they keep (some hold a blocked subject's letters).
BAD_SUBJECTS = tuple("""
casino poker slots jackpot roulette blackjack bingo bets betting lottery gambling wager baccarat
porn xxx sex sexy camgirls escorts nudes hentai milf erotic fetish hookup adult stripper
viagra cialis pills tramadol xanax steroids painkillers opioids weightloss pharma
warez keygen crack cracked torrent nulled serials malware spyware trojan cheats hacks pirated
payday loans cashadvance forex bitcoin faucet ponzi earnmoney getrich giveaway prizes sweepstakes winmoney
replica counterfeit knockoff fakewatches cheap
adserver ads adclick popup banners tracker tracking affiliates traffic clickbait
spam linkfarm backlinks seo phishing scam botnet doorway
""".split())
GOOD_SUBJECTS = tuple("""
university school college library museum history science physics biology chemistry mathematics geology astronomy
medicine hospital nursing dentist veterinary health nutrition cooking recipes bakery kitchen restaurant coffee tea
garden flowers forest farming nature wildlife birds fishing hiking camping mountain river ocean island beach
weather climate energy solar engineering robotics software programming computer network database hardware electronics
news journal magazine gazette herald tribune times post radio television cinema theatre film music guitar piano orchestra
book poetry novel literature writing language dictionary grammar translation philosophy religion church temple
law justice court police government parliament council city village county national embassy tax bank insurance pension
travel hotel flight railway airport cycling cars motor boat harbour shipping postal delivery market grocery clothing
shoes furniture carpentry plumbing painting pottery knitting sewing crafts toys puzzle chess football tennis cricket
running yoga swimming family parenting wedding children kindergarten charity volunteer community forum blog
photo gallery design architecture archive encyclopedia atlas map data statistics research institute laboratory
sussex alphabet cracker scampi tracksuit advice address adapt hackathon spinach betterment sextant therapy analysis
""".split())
#: Words that join either kind of subject, hosts' beginnings and ends, and paths.
JOINED = ("online", "world", "hub", "club", "shop", "zone", "my", "the", "best", "24", "get", "go", "top", "free", "land",
          "daily", "center", "express", "live", "plus", "direct", "star", "king", "site", "house", "life")
FRONTS = ("", "www.", "m.", "", "blog.", "www.", "en.", "")
ENDS = ("com", "net", "org", "info", "co.uk", "io", "de", "fr", "eu", "us", "edu", "biz")
#: Invented names to keep, of frequent English letter pairs.
PAIRS = ("th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha", "at", "en", "es", "of", "or", "nt", "ea", "ti",
         "to", "it", "st", "io", "le", "is", "ou", "ar", "as", "de", "rt", "ve")
PLAIN_PATHS = ("/", "/en/1042", "/about.html", "/2024/05/a-day-in-town", "/article/12", "/de/seite/7", "/index.php", "/fr/25930/")
BAD_PATHS = ("/{0}", "/{0}/today", "/buy-{0}", "/en/{0}-online.html")


@dataclass(frozen=True)
class UrlModel:
    """Weights of the hashed n-grams and the bias."""

    weights: tuple[float, ...]
    bias: float


def host_and_path(url: Column) -> Column:
    """Struct of host (A-Z lower-cased) and path, both empty without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3))
    return let(F.coalesce(rest, F.lit("")), lambda r: F.struct(
        F.translate(F.regexp_extract(r, r"(?s)^([^/?#]*)", 1), string.ascii_uppercase, string.ascii_lowercase).alias("host"),
        F.regexp_extract(r, r"(?s)^[^/?#]*([^?#]*)", 1).alias("path")))


def _grams(text: Column, kind: str) -> Column:
    """Hashed places of a text's n-grams."""
    chars = F.split(F.concat(F.lit("^"), text, F.lit("$")), "")

    def of(c, n):
        count = F.size(c) - (n - 1)
        return F.when(count > 0, F.transform(
            F.sequence(F.lit(0), F.greatest(count - 1, F.lit(0))),
            lambda i: F.pmod(F.xxhash64(F.lit(kind), F.concat(*[F.get(c, i + k) for k in range(n)])), F.lit(SPACE)).cast("int"))
        ).otherwise(F.array().cast("array<int>"))

    return F.when(text == "", F.array().cast("array<int>")).otherwise(
        let(chars, lambda c: F.concat(*[of(c, n) for n in SIZES])))


def places(host: Column, path: Column) -> Column:
    """Different n-gram places of a host and its path."""
    return F.array_distinct(F.concat(_grams(host, "h"), _grams(F.regexp_replace(path, r"\d+", "0"), "p")))


def hosts_of(subjects: Iterable[str]) -> list[str]:
    """Four hosts of each subject: alone, and joined with other words before and after."""
    out = []
    for k, s in enumerate(subjects):
        a, b, c = (JOINED[(k * step + step) % len(JOINED)] for step in (3, 5, 7))
        names = (s, f"{s}{a}", f"{b}{s}", f"{s}-{c}" if k % 2 else f"{c}-{s}")
        out += [f"{FRONTS[(k + n) % len(FRONTS)]}{name}.{ENDS[(k * 5 + n) % len(ENDS)]}" for n, name in enumerate(names)]
    return out


def labelled_urls(spark: SparkSession) -> DataFrame:
    """The small labelled table: url, label (1: block), about 1,750 rows made by a rule from the subjects."""
    made = [f"{FRONTS[k % 8]}{PAIRS[k % 30]}{PAIRS[k * 7 % 30]}{PAIRS[k * 11 % 30]}{PAIRS[k * 13 % 30] if k % 2 else ''}.{ENDS[k % 12]}"
            for k in range(120)]
    good_hosts = hosts_of(GOOD_SUBJECTS)
    bad = [h + PLAIN_PATHS[(k + n) % 8] for k, h in enumerate(hosts_of(BAD_SUBJECTS)) for n in (0, 3)]
    bad += [good_hosts[k * 11 % len(good_hosts)] + BAD_PATHS[k % 4].format(s) for k, s in enumerate(BAD_SUBJECTS)]
    good = [h + PLAIN_PATHS[k % 8] for k, h in enumerate(good_hosts)] + [h + PLAIN_PATHS[(k + 3) % 8] for k, h in enumerate(made)]
    good += [good_hosts[k * 13 % len(good_hosts)] + BAD_PATHS[k % 4].format(s) for k, s in enumerate(GOOD_SUBJECTS)]
    rows = [{"url": f"https://{u}", "label": 1.0} for u in bad] + [{"url": f"https://{u}", "label": 0.0} for u in good]
    return spark.range(0, 1, 1, 1).select(
        F.inline(F.from_json(F.lit(json.dumps(rows)), "array<struct<url:string,label:double>>")))


def train(labelled: DataFrame, reg: float = 0.005) -> UrlModel:
    """Fit the regression on a table of url and label (a small one: it is read a few dozen times)."""
    found = labelled.where("url is not null and label is not null").select(
        F.col("label").cast("double").alias("label"), host_and_path(F.col("url")).alias("u"))
    at = found.select("label", places(F.col("u.host"), F.col("u.path")).cast("array<string>").alias("at"))
    sparse = CountVectorizerModel.from_vocabulary(
        [str(i) for i in range(SPACE)], inputCol="at", outputCol="features", binary=True).transform(at)
    fit = LogisticRegression(regParam=reg, maxIter=100, standardization=False).fit(sparse)
    return UrlModel(tuple(float(x) for x in fit.coefficients.toArray()), float(fit.intercept))


def block_score(host: Column, path: Column, model: UrlModel) -> Column:
    """The probability that a url is to be blocked."""
    weights = F.from_json(F.lit(json.dumps([round(w, 9) for w in model.weights])), "array<double>")
    total = F.aggregate(places(host, path), F.lit(model.bias), lambda a, i: a + F.get(weights, i))
    return 1 / (1 + F.exp(-total))


def rule_of(host: Column, path: Column, rules: Iterable[tuple[str, str]]) -> Column:
    """The longest rule that fits the host (or a domain it lies under) and starts the path."""
    fits = []
    for _, rule in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
        name, slash, start = rule.partition("/")
        under = (host == name) | F.endswith(host, F.lit("." + name))
        fits.append(F.when(under & F.startswith(path, F.lit(slash + start)), F.lit(rule)))
    return F.coalesce(*fits)


def filter_urls(pages: DataFrame, model: UrlModel, rules: Iterable[tuple[str, str]] = RULES,
                url: str = "url") -> DataFrame:
    """Add host, path, rule (or null), block_score and verdict (allow or block)."""
    rules = list(rules)
    verdicts = dict((rule, verdict) for verdict, rule in rules)

    def judged(u):
        by_rule = F.lit(None).cast("string")
        rule = rule_of(u["host"], u["path"], rules)
        for name, verdict in verdicts.items():
            by_rule = F.when(rule == name, verdict).otherwise(by_rule)
        score = block_score(u["host"], u["path"], model)
        return let(F.struct(rule.alias("rule"), by_rule.alias("by_rule"), score.alias("score")), lambda x: F.struct(
            u["host"].alias("host"), u["path"].alias("path"), x["rule"].alias("rule"), x["score"].alias("block_score"),
            F.coalesce(x["by_rule"], F.when(x["score"] >= 0.5, "block").otherwise("allow")).alias("verdict")))

    return with_struct(pages, let(host_and_path(F.col(url)), judged))
