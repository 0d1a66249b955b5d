"""URL functions as Column expressions. All stay in generated code; none needs a UDF."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PATTERN = r"^([a-zA-Z][a-zA-Z0-9+.-]*)://([^/?#]*)([^?#]*)(\?[^#]*)?"
DEFAULT_PORTS = {"http": 80, "https": 443, "ftp": 21, "smb": 445}

# Second-level labels under which country domains register names.
SECOND_LEVEL = ("co", "com", "net", "org", "gov", "edu", "ac", "or", "ne", "go", "gob", "gov", "mil", "sch", "ltd", "plc", "me")


def scheme(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, PATTERN, 1))


def authority(url: Column) -> Column:
    return F.regexp_extract(url, PATTERN, 2)


def host(url: Column) -> Column:
    """Lower-case host without user and port."""
    return F.lower(F.regexp_replace(F.regexp_replace(authority(url), r"^.*@", ""), r":[0-9]*$", ""))


def port(url: Column) -> Column:
    """The port, or the scheme's default one, or -1."""
    given = F.regexp_extract(authority(url), r":([0-9]+)$", 1)
    out = F.when(given != "", given.try_cast("int"))
    for name, n in DEFAULT_PORTS.items():
        out = out.when(scheme(url) == name, n)
    return out.otherwise(-1)


def path(url: Column) -> Column:
    p = F.regexp_extract(url, PATTERN, 3)
    return F.when(p == "", F.lit("/")).otherwise(p)


def query(url: Column) -> Column:
    """The query without its question mark; empty if there is none."""
    return F.regexp_replace(F.regexp_extract(url, PATTERN, 4), r"^\?", "")


def resolved_path(url: Column) -> Column:
    """The path without its . and .. segments."""
    parts = F.slice(F.split(path(url), "/"), 2, 1 << 20)
    stack = F.aggregate(
        parts, F.expr("cast(array() as array<string>)"),
        lambda acc, s: F.when(s == ".", acc).when(s == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0)))).otherwise(F.concat(acc, F.array(s))),
    )
    tail = F.when(path(url).rlike(r"/\.{1,2}$"), F.lit("/")).otherwise(F.lit(""))
    joined = F.concat(F.lit("/"), F.array_join(stack, "/"))
    return F.when(path(url).contains("/."), F.when(joined.endswith("/"), joined).otherwise(F.concat(joined, tail))).otherwise(path(url))


def normal_form(url: Column) -> Column:
    """Lower-case scheme and host, no default port, no dot segments, a path, no fragment."""
    shown = F.when(port(url) == -1, F.regexp_extract(authority(url), r"(:[0-9]+)$", 1))
    for name, n in DEFAULT_PORTS.items():
        shown = shown.when((scheme(url) == name) & (port(url) == n), F.lit(""))
    shown = shown.otherwise(F.concat(F.lit(":"), port(url).cast("string")))
    user = F.regexp_extract(authority(url), r"^(.*@)", 1)
    return F.concat(scheme(url), F.lit("://"), user, host(url), shown, resolved_path(url), F.regexp_extract(url, PATTERN, 4))


def path_segments(url: Column) -> Column:
    """Folders of the path, without the file name."""
    folders = F.regexp_extract(path(url), r"^(.*)/[^/]*$", 1)
    return F.filter(F.split(folders, "/"), lambda s: s != "")


def file_name(url: Column) -> Column:
    return F.regexp_extract(path(url), r"([^/]*)$", 1)


def file_extension(url: Column) -> Column:
    """Lower-case extension of the file name, cut at a semicolon."""
    return F.lower(F.regexp_extract(F.regexp_replace(file_name(url), ";.*$", ""), r"\.([^.]*)$", 1))


def file_stem(url: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(file_name(url), ";.*$", ""), r"\.[^.]*$", "")


def tokens(text: Column) -> Column:
    """Runs of letters and digits, apart at capitals that follow small letters."""
    apart = F.regexp_replace(text, r"(\p{Ll})(\p{Lu})", "$1 $2")
    return F.filter(F.split(apart, r"[^\p{L}\p{N}]+"), lambda s: s != "")


def parameters(url: Column) -> Column:
    """Map of the query's keys to values; of a repeated key the last value."""
    pairs = F.transform(F.filter(F.split(query(url), "&"), lambda s: s != ""), lambda s: F.struct(F.regexp_extract(s, "^([^=]*)", 1).alias("k"), F.regexp_extract(s, "^[^=]*=(.*)$", 1).alias("v")))
    keys = F.array_distinct(F.transform(pairs, lambda p: p["k"]))
    return F.map_from_arrays(keys, F.transform(keys, lambda k: F.element_at(F.transform(F.filter(pairs, lambda p: p["k"] == k), lambda p: p["v"]), -1)))


def domain_class(host_: Column) -> Column:
    """The top-level domain, with the second-level label if that is one under which names are registered."""
    last, second = F.substring_index(host_, ".", -1), F.substring_index(host_, ".", -2)
    label = F.substring_index(second, ".", 1)
    listed = label.isin(*sorted(set(SECOND_LEVEL))) & (F.length(last) == 2) & (F.size(F.split(host_, r"\.")) > 2)
    return F.when(listed, second).otherwise(last)


def organization(host_: Column) -> Column:
    rest = F.substring(host_, F.lit(1), F.length(host_) - F.length(domain_class(host_)) - 1)
    return F.substring_index(rest, ".", -1)


def subdomain(host_: Column) -> Column:
    rest = F.substring(host_, F.lit(1), F.length(host_) - F.length(domain_class(host_)) - 1)
    return F.regexp_extract(rest, r"^(.*)\.[^.]*$", 1)


def organization_domain(host_: Column) -> Column:
    return F.concat_ws(".", organization(host_), domain_class(host_))


def without_www(host_: Column) -> Column:
    return F.regexp_replace(host_, r"^www\.", "")


def sub_urls(url: Column) -> Column:
    """All folders above a URL, from the host down."""
    parts = path_segments(url)
    base = F.concat(scheme(url), F.lit("://"), host(url))
    return F.transform(F.sequence(F.lit(0), F.size(parts)), lambda i: F.concat(base, F.lit("/"), F.when(i > 0, F.concat(F.array_join(F.slice(parts, 1, i), "/"), F.lit("/"))).otherwise(F.lit(""))))


def embedded_url(url: Column) -> Column:
    """A URL that stands inside another, after its first eight characters; null if there is none."""
    inner = F.regexp_extract(url, r"^.{8}.*?(https?://.*)$", 1)
    www = F.regexp_extract(url, r"^.{11}.*?/(www\..*)$", 1)
    return F.when(inner != "", inner).when(www != "", F.concat(F.lit("http://"), www))


def rewritten(url: Column, rules: list[tuple[str, str]]) -> Column:
    """Each rule in turn: where its pattern matches the whole URL, all matches are replaced."""
    out = url
    for pattern, replacement in rules:
        out = F.when(out.rlike(f"^(?:{pattern})$"), F.regexp_replace(out, pattern, replacement)).otherwise(out)
    return out


def shortened(url: Column, length: int = 40) -> Column:
    """For display: the start and the file name, with dots between, if the URL is longer than so."""
    name = file_name(url)
    return F.when(F.length(url) <= length, url).when(
        F.length(name) + 10 >= length, F.concat(F.substring(url, 1, length - 3), F.lit("..."))
    ).otherwise(F.concat(F.substring(url, F.lit(1), F.lit(length - 3) - F.length(name)), F.lit("..."), name))


def decoded(url: Column) -> Column:
    """Percent decoding; a plus is a blank after the question mark only; what is malformed stays as it is."""
    at = F.instr(url, "?")
    head = F.when(at > 0, F.substring(url, F.lit(1), at - 1)).otherwise(url)
    tail = F.when(at > 0, F.substring(url, at, F.length(url))).otherwise(F.lit(""))
    return F.concat(F.coalesce(F.try_url_decode(F.regexp_replace(head, r"\+", "%2B")), head), F.coalesce(F.try_url_decode(tail), tail))


def is_local(host_: Column) -> Column:
    """Loop-back and private addresses, and names without a dot."""
    return (host_ == "localhost") | host_.rlike(r"^(127|10)\.[0-9.]+$|^192\.168\.|^172\.(1[6-9]|2[0-9]|3[01])\.|^169\.254\.") | ~host_.contains(".")


# Patterns of the machine itself and of private networks, and the classes of hosts that no table of domains names.
LOCALHOST = r"localhost|127\..*|\[?fe80:.*|\[?0:0:0:0:0:0:0:1.*|\[?::1"
INTRANET = r"10\..*|172\.(1[6-9]|2[0-9]|3[01])\..*|169\.254\..*|192\.168\..*|\[?(fc|fd).*:.*"
GENERIC, LOCAL = 6, 7


def without_zone(host_: Column) -> Column:
    """An address without the zone after its percent sign."""
    return F.substring_index(host_, "%", 1)


def is_localhost(host_: Column) -> Column:
    """The machine itself; so is a missing host, as of files."""
    return host_.isNull() | without_zone(host_).rlike(rf"(?i)^({LOCALHOST})(/.*)?\]?$")


def is_intranet(host_: Column) -> Column:
    """The machine itself or a private network."""
    return is_localhost(host_) | host_.rlike(rf"(?i)^({INTRANET})$")


def domain_classes(df: DataFrame, host_: str, classes: DataFrame, out: str) -> DataFrame:
    """The rows with the class of their host's last label by a table (tld, class), whose first class in order counts; LOCAL for private
    hosts that it does not name and for missing or empty ones, GENERIC for the rest."""
    named = classes.where(F.col("tld").isNotNull()).groupBy(F.lower("tld").alias("_tld")).agg(F.min("class").alias("_class"))
    label = F.when(F.col(host_).contains("."), F.lower(F.substring_index(host_, ".", -1)))
    found = df.withColumn("_tld", label).join(named, "_tld", "left")
    nothing = F.coalesce(F.col(host_), F.lit("")) == ""
    return found.withColumn(out, F.when(nothing, LOCAL).otherwise(F.coalesce("_class", F.when(is_intranet(F.col(host_)), LOCAL).otherwise(GENERIC)))).drop("_tld", "_class")


def same_site(own_host: Column, other_host: Column) -> Column:
    """By suffix, with www. left out: how link counts tell inbound from outbound."""
    return other_host.endswith(without_www(own_host))


def same_host(own_host: Column, other_host: Column) -> Column:
    """By equality, with www. left out: how link lists tell them."""
    return without_www(own_host) == without_www(other_host)
