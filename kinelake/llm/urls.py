"""URL filter: longest matching rule, else logistic regression on hashed character n-grams of host and path."""

from __future__ import annotations

import zlib
from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinelake.llm.shared import ascii_lower, let, steps, table

DIMS, GRAMS, MAX_LABELLED = 8192, (3, 4, 5), 5000

#: (verdict, host, path); the contract's rules.
RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/")]

_BAD = "spam casino pills bets adult xxx porn poker viagra cialis jackpot lottery loans payday crack warez torrent escort nude betting gamble slots replica malware phish keygen ads track".split()
_PAIR = "farm win cheap free x online best hot club buy top deals bonus now".split()
_GOOD = "news blog wiki docs school library museum garden science history travel recipe music health sport weather research art code data forum photo market city river bank hotel train book".split()
_SYLLABLES = "th er on an re he in ed nd ha at en es of or nt ea ti to it st le is ou ar as de rt ve tion ing ble ly wh sh men la ro ne ci".split()


def labelled_urls() -> list[tuple[str, int]]:
    """A small labelled table (1: block), by a rule: every bad word in a few hosts and paths, and plain words and syllables elsewhere."""
    tops, marks, langs = ("com", "net", "org"), ("", "www.", "m.", "blog."), ("en", "de", "fr", "es")
    out = []
    for i, bad in enumerate(_BAD):
        for k in range(9):
            pair, n = _PAIR[(i + 5 * k) % len(_PAIR)], 37 * i + 211 * k
            name = (f"{pair}-{bad}", f"{bad}-{pair}", f"{bad}{pair}")[(i + k) % 3]
            out.append((f"http://{marks[(i + k) % 4]}{name}.example.{tops[k % 3]}/{langs[(i + 2 * k) % 4]}/{n}", 1))
        out.append((f"https://{_SYLLABLES[i]}{_SYLLABLES[-i]}.example.{tops[i % 3]}/{bad}/{i}.html", 1))
    syllables = len(_SYLLABLES)
    names = [x for g in _GOOD for x in (g, f"{g}{_PAIR[len(g)]}", f"my-{g}")]
    names += [_SYLLABLES[i % syllables] + _SYLLABLES[(i * 7 + 3) % syllables] + _SYLLABLES[(i * 13 + 5) % syllables] * (i % 2) for i in range(600)]
    names += [_SYLLABLES[i // syllables] * 2 + _SYLLABLES[i % syllables] for i in range(syllables * 12)]
    for i, name in enumerate(names):
        out.append((f"https://{marks[(i // 3) % 4]}{name}.example.{tops[i % 3]}/{langs[(i // 5) % 4]}/{(41 * i) % 999}" + ("", ".html", "/")[(i // 7) % 3], 0))
    return out


def _split(url: str) -> tuple[str, str]:
    """Host and path, as ``host_path`` has them; for training rows."""
    rest = url.partition("://")[2] if "://" in url else ""
    cut = min([i for i in map(rest.find, "/?#") if i >= 0], default=len(rest))
    host, path = rest[:cut], rest[cut:]
    end = min([i for i in map(path.find, "?#") if i >= 0], default=len(path))
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path[:end]


def _features(host: str, path: str) -> np.ndarray:
    s, x = f"^{host}|{path}$", np.zeros(DIMS)
    for n in GRAMS:
        for i in range(len(s) - n + 1):
            x[zlib.crc32(s[i : i + n].encode()) % DIMS] += 1
    return x / max(1, len(s))


@lru_cache(maxsize=4)
def train(rows: tuple[tuple[str, int], ...], steps: int = 600, rate: float = 8.0, l2: float = 1e-4, scale: float = 20.0) -> tuple[tuple[float, ...], float]:
    """Weights and bias by gradient descent, both classes weighing the same, on at most ``MAX_LABELLED`` labelled rows (more raise an error)."""
    if len(rows) > MAX_LABELLED:
        raise ValueError(f"the labelled table may have {MAX_LABELLED} rows")
    x, y = scale * np.array([_features(*_split(u)) for u, _ in rows]), np.array([float(v) for _, v in rows])
    share = np.clip(y.mean(), 1e-6, 1 - 1e-6)
    weigh, w, b = np.where(y == 1, 0.5 / share, 0.5 / (1 - share)) / len(y), np.zeros(DIMS), 0.0
    for _ in range(steps):
        g = weigh * (1 / (1 + np.exp(-np.clip(x @ w + b, -30, 30))) - y)
        w, b = w - rate * (x.T @ g + l2 * w), b - 0.3 * rate * float(g.sum())
    return tuple(np.round(w * scale, 9)), round(b, 9)


def host_path(url: Column) -> tuple[Column, Column]:
    u = F.coalesce(url, F.lit(""))
    return ascii_lower(F.regexp_extract(u, "://([^/?#]*)", 1)), F.regexp_extract(u, "://[^/?#]*([^?#]*)", 1)


def block_probability(host: Column, path: Column, weights, bias: float) -> Column:
    """Of one n-gram length after another the hashed features are looked up and summed; all JVM-side.

    The url is split into its characters once, so that a long one costs in proportion to its length.
    """
    s, w = F.concat(F.lit("^"), host, F.lit("|"), path, F.lit("$")), F.array(*[F.lit(float(v)) for v in weights])

    def gram_sum(chars: Column, n: int) -> Column:
        gram = lambda i: F.concat(*[F.get(chars, i + k) for k in range(n)])
        return F.aggregate(steps(F.size(chars) - (n - 1)), F.lit(0.0), lambda a, i: a + F.get(w, (F.crc32(gram(i).cast("binary")) % DIMS).cast("int")))

    def scored(chars: Column) -> Column:
        total = gram_sum(chars, GRAMS[0])
        for n in GRAMS[1:]:
            total = total + gram_sum(chars, n)
        return 1 / (1 + F.exp(-(total / F.size(chars) + bias)))

    return let(F.filter(F.split(s, ""), lambda c: c != ""), scored)


def filter_urls(pages: DataFrame, rules=RULES, labelled=None, block_at: float = 0.5) -> DataFrame:
    """``page_id, host, path, rule, probability, verdict`` of every row.

    The longest rule whose host is the url's or a parent of it, and whose path begins the url's, decides;
    without one, the model does. A null url or one without ``://`` has an empty host and path and is judged
    by the model; the longest rule's ties can't occur, as a host has one parent of each length; repeated rows are judged
    alike; a very long url is judged whole, in time proportional to its length; an empty table gives no rows; other
    columns of the input are not looked at.
    """
    weights, bias = train(tuple(labelled if labelled is not None else labelled_urls()))
    host, path = host_path(F.col("url"))
    parts = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, h, p in sorted(rules, key=lambda r: (len(r[1]) + len(r[2]), r[1])):
        fits = ((F.col("host") == h) | F.col("host").endswith("." + h)) & F.col("path").startswith(p)
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(kind)).otherwise(verdict)
    scored = parts.select("*", rule.alias("rule"), verdict.alias("ruled"), block_probability(F.col("host"), F.col("path"), weights, bias).alias("probability"))
    model = F.when(F.col("probability") >= block_at, "block").otherwise("allow")
    return scored.select("page_id", "host", "path", "rule", "probability", F.coalesce("ruled", model).alias("verdict"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")
