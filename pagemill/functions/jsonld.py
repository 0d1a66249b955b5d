"""Linked data: JSON-LD blocks of pages in expanded, flat, compact and tree form."""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import DataFrame

from pagemill.arrow import map_rows
from pagemill.functions import html

# Prefixes of common vocabularies.
PREFIXES = {
    "schema": "http://schema.org/", "dc": "http://purl.org/dc/elements/1.1/", "dct": "http://purl.org/dc/terms/", "foaf": "http://xmlns.com/foaf/0.1/", "og": "http://ogp.me/ns#", "geo": "http://www.w3.org/2003/01/geo/wgs84_pos#",
    "rdf": "http://www.w3.org/1999/02/22-rdf-syntax-ns#", "rdfs": "http://www.w3.org/2000/01/rdf-schema#", "owl": "http://www.w3.org/2002/07/owl#", "skos": "http://www.w3.org/2004/02/skos/core#", "cc": "http://creativecommons.org/ns#",
}


def context_of(c: Any) -> dict[str, str]:
    """Term to IRI; a context that is only an address is the default vocabulary."""
    out: dict[str, str] = {}
    for x in c if isinstance(c, list) else [c]:
        if isinstance(x, str):
            out["@vocab"] = x.rstrip("/#") + "/"
        elif isinstance(x, dict):
            out |= {k: v["@id"] if isinstance(v, dict) else v for k, v in x.items() if isinstance(v, str) or isinstance(v, dict) and "@id" in v}
    return out


def iri(term: str, context: dict[str, str]) -> str:
    if term.startswith("@") or "://" in term:
        return term
    if term in context:
        return iri(context[term], {k: v for k, v in context.items() if k != term})
    prefix, colon, rest = term.partition(":")
    if colon and (base := context.get(prefix) or PREFIXES.get(prefix)):
        return base + rest
    return context.get("@vocab", "") + term


def expand(node: Any, context: dict[str, str] | None = None) -> Any:
    """Properties as full addresses, values as lists of objects."""
    context = context or {}
    if isinstance(node, list):
        out: list = []
        for x in node:
            e = expand(x, context)
            out += e if isinstance(e, list) else [e]
        return out
    if not isinstance(node, dict):
        return {"@value": node}
    if "@context" in node:
        context = context | context_of(node["@context"])
    props: dict[str, Any] = {}
    for k, v in node.items():
        if k == "@context" or v is None:
            continue
        if k == "@graph":
            return expand(v, context)
        if k == "@type":
            props[k] = [iri(t, context) for t in (v if isinstance(v, list) else [v])]
        elif k in ("@id", "@value", "@language"):
            props[k] = v
        else:
            e = expand(v, context)
            props.setdefault(iri(k, context), []).extend(e if isinstance(e, list) else [e])
    return props


def flatten(nodes: Any) -> list[dict]:
    """One entry for each node; nested ones are referred to by @id."""
    table: dict[str, dict] = {}
    blank = iter(range(1 << 30))

    def add(n: dict) -> dict:
        name = n.get("@id") or f"_:b{next(blank)}"
        entry = table.setdefault(name, {"@id": name})
        for k, v in n.items():
            if k == "@id":
                continue
            if k == "@type":
                entry[k] = list(dict.fromkeys(entry.get(k, []) + v))
                continue
            for x in v:
                y = add(x) if isinstance(x, dict) and "@value" not in x else x
                if y not in entry.setdefault(k, []):
                    entry[k].append(y)
        return {"@id": name}

    for n in nodes if isinstance(nodes, list) else [nodes]:
        if isinstance(n, dict) and "@value" not in n:
            add(n)
    return list(table.values())


def short(name: str) -> str:
    """With its prefix, whether it says http or https."""
    plain = name.replace("https://", "http://", 1)
    for prefix, base in PREFIXES.items():
        if plain.startswith(base):
            return f"{prefix}:{plain[len(base):]}"
    return name


def compact(node: Any) -> Any:
    """Short names, and single values without their lists and objects."""
    if isinstance(node, list):
        out = [compact(x) for x in node]
        return out[0] if len(out) == 1 else out
    if isinstance(node, dict):
        if set(node) == {"@value"}:
            return node["@value"]
        return {short(k): [short(t) for t in v] if k == "@type" and len(v) > 1 else short(v[0]) if k == "@type" else compact(v) for k, v in node.items()}
    return node


def tree(flat: list[dict]) -> list[dict]:
    """Compact nodes nested where they are referred to; a reference that would close a circle stays a reference."""
    table = {n["@id"]: n for n in flat}
    used: set[str] = set()

    def grow(name: str, above: frozenset) -> Any:
        n = table[name]
        out = {} if name.startswith("_:") else {"@id": name}
        for k, v in n.items():
            if k == "@id":
                continue
            if k == "@type":
                out[k] = compact({k: v})["@type"]
                continue
            parts = []
            for x in v:
                to = x.get("@id") if isinstance(x, dict) and set(x) == {"@id"} else None
                if to in table and to not in above and to != name:
                    used.add(to)
                    parts.append(grow(to, above | {name}))
                else:
                    parts.append(compact(x))
            out[short(k)] = parts[0] if len(parts) == 1 else parts
        return out

    grown = {name: grow(name, frozenset()) for name in table}
    roots = [n for n in table if n not in used] or list(table)[:1]
    return [grown[n] for n in roots]


def forms(blocks: list[str]) -> dict[str, str | None]:
    """All forms of a page's blocks as JSON; blocks that do not parse are left out."""
    nodes: list = []
    for b in blocks or []:
        try:
            e = expand(json.loads(b))
        except (ValueError, RecursionError):
            continue
        nodes += e if isinstance(e, list) else [e]
    flat = flatten(nodes)
    as_json = lambda x: json.dumps(x, ensure_ascii=False, sort_keys=True)
    return {"ld": as_json(nodes), "flat": as_json(flat), "compact": as_json([compact(n) for n in flat]), "tree": as_json(tree(flat))}


def validate(pages: DataFrame, page: str = "html", url: str = "url") -> DataFrame:
    """url and the forms of each page's linked data."""

    def rows(it):
        for r in it:
            yield {"url": r["url"]} | forms(html.parse(r["html"], r["url"])["ld"])

    from pyspark.sql import functions as F

    return map_rows(pages.select(F.col(url).alias("url"), F.col(page).alias("html")), rows, "url string, ld string, flat string, compact string, tree string")
