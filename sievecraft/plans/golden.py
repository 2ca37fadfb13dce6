"""Character-level functions applied to templates of their cases, filled in with each supplier's own word.

A case is an input and its output, both with ``qq`` where the word stands; every query
has a row for each case and supplier, and its SQL fills the outputs in.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievecraft import profile as fixed
from sievecraft.functions import annex, translate
from sievecraft.functions import grammar as g
from sievecraft.plans import synthetic as syn
from sievecraft.profile import Profile
from sievecraft.sources.catalogue import slug

HEAD, END = fixed.ANCHOR, fixed.SEP_FINAL
MODERN, FRAMELESS, LEGACY, ENUMERATE, PLAIN_CSS = Profile(), Profile(safari_version=18), Profile(legacy=True), Profile(document_policy="enumerate"), Profile(allow_has=False)


def _or_code(function: Callable) -> Callable[[str], str]:
    def run(text: str) -> str:
        try:
            return " ; ".join(function(text))
        except g.Rejected as e:
            return "! " + e.code

    return run


def _actions(profile: Profile = MODERN) -> Callable[[str], str]:
    def run(text: str) -> str:
        got = translate.network(text, profile)
        return got["reason"] or " ; ".join(r["action"] for r in got["rules"])

    return run


def _triggers(profile: Profile = MODERN, *keys: str) -> Callable[[str], str]:
    """What the first trigger of a rule says besides its address."""

    def run(text: str) -> str:
        got = translate.network(text, profile)
        found = {k: v for k, v in (got["rules"][0]["trigger"] if got["rules"] else {}).items() if k in keys or (not keys and k != "url-filter")}
        return got["reason"] or " ; ".join(f"{k}={','.join(v) if isinstance(v, list) else v}" for k, v in sorted(found.items()))

    return run


def _annex(*fields: str) -> Callable[[str], str]:
    return lambda text: " ; ".join(" ".join(",".join(e[f]) if isinstance(e[f], list) else str(e[f]) for f in fields) for e in translate.network(text, MODERN)["annex"])


def _cosmetic(text: str) -> str:
    entry, note = annex.cosmetic_entry(*translate.split_cosmetic(text))
    return note or (f"{entry['family']}:{','.join(entry.get('domains', []))}" if entry else "")


def _selector(profile: Profile) -> Callable[[str], str]:
    return lambda text: translate.selector_fault(text, profile) or "ok"


def _page_matches(text: str) -> str:
    """Path and address, told whether the page is one."""
    path, address = text.split(" ")
    return str(bool(re.search(g.path_page(path), address)))


_MODERN_TYPES, _LEGACY_TYPES = ([t for t in types if t != "document"] for types in (fixed.ALL_TYPES, fixed.ALL_TYPES_LEGACY))

#: name: function on a text, and its cases.
CASES: dict[str, tuple[Callable[[str], str], dict[str, str]]] = {
    "fn04_to_fn10_expressions": (_or_code(g.lower_regex), {
        "qq-z{1,3}!": "qq-zz?z?!", "qq(?:jpg)": "qq(jpg)", "qq.+?-?": "qq.+-?", r"[qq]{2}\.gif": r"[qq][qq]\.gif", "qq-k{3,}": "qq-kkkk*", "qq-k{0,3}": "qq-k?k?k?", "(qq){3}": "(qq)(qq)(qq)",
        "qq.{40,}": "! rx_repeat_any_long", r"qq\W_": "qq[^a-zA-Z0-9_]_", r"qq[\W%]": "! rx_neg_class_in_class", "qq(?!x)": "! rx_lookaround", "qq^x": "! rx_anchor", "qq(?<=y)": "! rx_lookaround",
        r"qq[\s\S]+z": "qq.+z", r"qq[^\S]x": "! rx_neg_class_in_class", r"qq[\S%]+": "qq.+", r"qq\d{2}-": "qq[0-9][0-9]-", r"[\w%]qq": "[a-zA-Z0-9_%]qq", r"qq\S": "qq[^ ]",
        "qq-k{5,4}": "! rx_repeat_reversed", "{3}qq": "! rx_brace", "qq-k{1900}": "! rx_repeat_long", "qq-(u|v|w)/": "qq-(u)/ ; qq-(v)/ ; qq-(w)/", "u|qq": "u ; qq", "(u|qq)?/": "(u)?/ ; (qq)?/",
        "(u|qq)*": "! rx_alt_quantified", "((u|qq)v)": "! rx_subset", r"(?:^|/)qq": r"^qq ; (/)qq", "(^qq)/": "^(qq)/", "qq(/$)": "qq(/)$", r"qq(?:$|/)": "qq$ ; qq(/)", "(qq": "! rx_unbalanced", "[qq": "! rx_unclosed_class", "qq)": "! rx_invalid",
    }),
    "fn11_frames": (lambda t: " ; ".join(g.frame_filters(t)), {"qq.*": HEAD + r"qq\.", "qq.net": HEAD + r"qq\.net" + END, "/qq-(u|v)/": f"{HEAD}qq-(u) ; {HEAD}qq-(v)", "/qq(?=x)/": "", "/^qq[0-9]$/": f"{HEAD}qq[0-9]{END}", "*.qq": ""}),
    "fn13_idna": (g.normalise_pattern, {"||bär.at/qq/ß": "||xn--br-via.at/qq/%C3%9F", "qq": "qq", "/qq/ñ": "/qq/%C3%B1"}),
    "fn14_page_pattern": (g.page_pattern, {"||qq.net/v1?": fixed.JS_ANCHOR + r"qq\.net\/v1\?", "|qq*|": "^qq.*$", "/qq+/": "qq+", "qq^": "qq" + fixed.JS_SEPARATOR}),
    "fn15_path_page": (g.path_page, {"": fixed.JS_HEAD + r"/?(?:[?#]|$)", "/qq": fixed.JS_HEAD + r"\/qq", "/^qq+/": fixed.JS_HEAD + "(?:qq+)", "/qq+/": fixed.JS_HEAD + ".*(?:qq+)", "qq": fixed.JS_HEAD + "[^?#]*qq", "/qq.x/": fixed.JS_HEAD + r"\/qq\.x\/"}),
    "fn15_path_matches": (_page_matches, {"/qq https://shop.net/qq/7": "True", "/qq https://shop.net/other": "False", " https://qq.net/": "True", " https://qq.net/deep": "False", "qq https://shop.net/a/qq.html": "True", "/^\\/qq$/ https://shop.net/qq": "True"}),
    "fn16_slash_parts": (lambda t: " ; ".join(g.slash_parts(t)), {r"/qq\/u/v\/w/i": r"qq\/u ; v\/w ; i", "/qq/": "qq ; "}),
    "fn17_rule_key": (lambda t: " ; ".join(map(str, translate.rule_key(t, "badfilter"))).replace("\x1f", ","), {"||qq.net^$image,1p": "False ; ||qq.net^ ; 1p,image", "@@||qq^$domain=v|u,badfilter": "True ; ||qq^ ; domain=u|v", "qq$from=z.net|y.net,~font": "False ; qq ; from=y.net|z.net,~font"}),
    "fn19_denyallow": (lambda t: " ; ".join(translate.denyallow_patterns(*t.split(" "))), {"qq.net /pic.gif": "||qq.net/pic.gif ; ||qq.net/*/pic.gif", "qq.net pic": "||qq.net/*pic ; ||qq.net/*/*pic", "qq.net *": "||qq.net^", "qq.net ||else.net/p": "||qq.net^"}),
    "fn20_selector_list": (lambda t: " ; ".join(g.split_selectors(t)), {"h1, .qq:where(u, v)": "h1 ; .qq:where(u, v)", "[qq=','], y": "[qq=','] ; y", 'p:not([t="(,"]), qq': 'p:not([t="(,"]) ; qq'}),
    "f06_costly": (lambda t: str(g.costly_selector(t)), {".qq": "False", "#qq ~ *": "True", ".qq > *": "True", ":not(.qq)": "True", "*": "False", "qq + [k]": "False", ".qq :is(a, b)": "True"}),
    "p05_modifiers": (lambda t: " ; ".join(g.split_modifiers(t)), {"from=/qq{2},u/,image,1p": "from=/qq{2},u/ ; image ; 1p", "qq,(u,v),w": "qq ; (u,v) ; w", r"x=qq\,y,z": r"x=qq\,y ; z"}),
    "p06_pipes": (lambda t: " ; ".join(g.split_pipes(t)), {r"qq.net|/(u|v)\.net/|~w.net": r"qq.net ; /(u|v)\.net/ ; ~w.net"}),
    "p08_dispatch": (_actions(), {
        "||qq.net^$domain=u.net|~v.net": "dom_mixed", "||qq.net^$dnsrewrite=10.1.1.1": "dns_redirect", "||qq.net^$dnsrewrite=refused": "block", "*$image,denyallow=qq.net": "denyallow_generic", "@@||qq.net^$jsinject": "exc_no_effect:jsinject",
        "||qq.net^$cookie": "block-cookies", "||qq.net^$cookie=qq": "cookie_named", "*$font,denyallow=qq.net|u.net,domain=v.net": "block" + " ; ignore-previous-rules" * 2, "/qq(1|2|3)/": "block ; block ; block",
        "@@||qq.net^$image": "ignore-previous-rules", "||qq.net^$method=post": "block", "||qq.net^$method=~post": "method_unknown", "@@*$document": "exc_no_scope", "||qq.net^$qq": "mod_unknown:qq", "||qq.net^$header=qq": "mod_unsupported:header",
        "||qq.net^$badfilter": "badfilter_directive", "||qq.net^$important,all": "block", "||qq.net^$match-case,~third-party": "block",
    }),
    "p12_context": (_triggers(), {"||qq.net^$subdocument": "load-context=child-frame ; resource-type=document", "||qq.net^$~third-party": "load-type=first-party", "||qq.net^$1p": "load-type=first-party", "||qq.net^$method=PUT": "request-method=put", "||qq.net^$match-case": "url-filter-is-case-sensitive=True"}),
    "p13_conditions": (_triggers(), {"||qq^$domain=u.net|qq.net": "if-domain=*u.net,*qq.net", "||u^$domain=~qq.net": "unless-domain=*qq.net", "||u^$domain=qq.*|b.net": f"if-frame-url={HEAD}b\\.net{END},{HEAD}qq\\."}),
    "p15_page_exceptions": (_triggers(), {"@@||qq.net^$document": f"if-top-url={HEAD}qq\\.net{END}", "@@*$document,domain=qq.net": "if-domain=*qq.net", "@@*$document,domain=qq.*": "exc_no_scope"}),
    "p16_partial": (_triggers(), {"@@||qq.net^$generichide": f"if-top-url={HEAD}qq\\.net{END}", "@@*$ehide,domain=qq.net|a.net": "if-domain=*a.net,*qq.net", "@@||qq.net^$urlblock": f"if-top-url={HEAD}qq\\.net{END}"}),
    "p17_redirect": (_actions(), {"||qq.net/lib.js^$script,redirect=empty:9": "block", "||qq.net^$redirect-rule=empty": "mod_unsupported:redirect-rule", "@@||qq.net^$redirect=empty": "mod_unsupported:redirect"}),
    "p00b_legacy": (_triggers(LEGACY), {"||qq.net^$xhr": "resource-type=raw", "||qq.net^": f"resource-type={','.join(_LEGACY_TYPES)}", "||qq.net^$subdocument": "resource-type=document", "||qq.net^$method=get": "method_profile"}),
    "p00b_enumerate": (_triggers(ENUMERATE), {"||qq.net^": f"resource-type={','.join(_MODERN_TYPES)}", "||qq.net^$image": "resource-type=image", "@@||qq.net^": "", "||qq.net^$~image": f"resource-type={','.join(t for t in _MODERN_TYPES if t != 'image')}"}),
    "p00b_frameless": (_triggers(FRAMELESS), {"||u.net^$domain=qq.net": "if-domain=*qq.net", r"||u.net^$domain=/qq\.net/": "dom_inexpressible", "||u.net^$method=get": "method_profile", "||u.net^$domain=qq.*": "if-domain=" + ",".join(sorted(f"*qq.{t}" for t in fixed.TLDS))}),
    "f04_without_has": (_selector(PLAIN_CSS), {".qq": "ok", ".qq:has(b)": "sel_has_off", ".qq:contains(b)": "sel_extended", ".qq{": "sel_style"}),
    "p20_path_top": (lambda t: translate.path_top_url(*t.split(" ")), {"qq.net /x": HEAD + r"qq\.net/x", " /qq.html": fixed.ANY_HOST + r"/qq\.html"}),
    "p21_side_table": (_cosmetic, {"qq.*##+js(log, u, 2)": "scriptlets:qq.*", "*.qq##div:contains(u)": "annex:scope_unreadable", "qq.net##^iframe": "html:qq.net", "qq.net#$#p { margin: 0 }": "styles:qq.net", "qq.net##^responseheader(u)": "annex:responseheader", "qq.net#%#run()": "raw_js:", "qq.net#?#p:upward(2)": "procedural:qq.net", "qq.net#@#+js()": "scriptlets:qq.net"}),
    "p22_quoted_args": (lambda t: " ; ".join(g.quoted_args(t)), {"'log', 'qq', '7'": "log ; qq ; 7", "\"qq,v\", w": "qq,v ; w", "'qq\\'s'": "qq\\'s"}),
    "p23_bare_args": (lambda t: " ; ".join(g.bare_args(t)), {"log, qq.v, 7, ": "log ; qq.v ; 7", "log, , qq": "log ;  ; qq", r"qq\,v": "qq,v", r"qq\d": r"qq\d"}),
    "p24_scope": (_or_code(lambda t: [",".join(g.scope(t)["domains"]), ",".join(g.scope(t)["excluded"])]), {"qq.net,a.net,~u.a.net": "a.net,qq.net ; u.a.net", "*.qq": "! scope_unreadable", "~qq.net": " ; qq.net"}),
    "p25_scope_domain": (lambda t: str(g.scope_domain(t)), {"qq.NET": "qq.net", "qq.*": "qq.*", "/qq+/": "/qq+/", "/qq(/": "None", "qq>>": "qq", "*.qq": "None", "qq.net.": "qq.net"}),
    "p26_style": (lambda t: " ; ".join(g.split_style(t) or ()), {".qq.open {left:1px;}": ".qq.open ; left:1px;", 'p[k="{qq}"] { color: red }': 'p[k="{qq}"] ; color: red', "qq": "", "qq { a { b }": ""}),
    "p27_side_network": (_annex("family", "domains"), {"$csp=img-src 'none',domain=qq.net": "csp qq.net", "||u^$removeparam=qq,domain=qq.net": "removeparams qq.net", "||u^$cookie=qq": "cookies ", "||u^$urlskip=?qq": "urlskips ", "||u^$redirect=qq": "redirects ", "||u^$csp=x,image,domain=qq.net": "", "||u^$removeparam=qq,to=v": ""}),
    "p28_replace": (_annex("args", "domains"), {
        r"||qq.net/data$xhr,domain=u.net,replace=/k\/l/m\/n/i": " ; ".join([r"/k\/l/i,m/n,qq.net/data u.net"] * 2), "||qq.net/*$xhr,1p,replace=/k/l/": "", "||qq.net/d$xhr,1p,replace=/k/l/": " ; ".join(["/k/,l,qq.net/d qq.net"] * 2), "||qq.net/d$font,1p,replace=/k/l/": "",
    }),
    "p29_top_level": (lambda t: " ; ".join(g.Domains().add(t, False).included), {"it": "*it", "qq.net>>": "*qq.net", "qq.net|~u.net": "*qq.net"}),
    "src05_slug": (slug, {"Žlutý qq & Co": "zluty-qq-and-co", "": "list", "U  qq--V": "u-qq-v"}),
    "src10_directive": (lambda t: str(g.directive_holds(t)), {"adguard && !qq": "True", "qq": "False", "(qq || adguard": "True", "!(qq && b)": "True", "!(!qq || adguard) || qq": "False", "qq adguard": "False", "adguard qq": "True", "!(adguard": "False"}),
    "src09_directives": (lambda t: " ".join(g.preprocess(t.split(" | "))[0]), {"qq | !#if x | b | !#else | c | !#endif | d": "qq c d", "!#if adguard | qq | !#if x | b | !#endif | !#endif": "qq"}),
}
WORD = "concat('w', s_suppkey)"


def _query(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        function, cases = CASES[name]
        apply = F.udf(function, "string", useArrow=True)
        rows = syn.sql(spark, sf_dir, f"SELECT {WORD} AS word FROM supplier").select("word", F.explode(F.array(*map(F.lit, cases))).alias("case"))
        filled = rows.select("case", "word", F.replace("case", F.lit("qq"), F.col("word")).alias("input"))
        return filled.select("input", "word", apply("input").alias("output"))

    return run


def _oracle(cases: dict[str, str]) -> str:
    quoted = lambda t: "'" + t.replace("'", "''") + "'"
    values = ", ".join(f"({quoted(k)}, {quoted(v)})" for k, v in cases.items())
    return f"SELECT replace(a, 'qq', word) AS input, word, replace(b, 'qq', word) AS output FROM (VALUES {values}) t(a, b), (SELECT {WORD} AS word FROM supplier) s"


QUERIES = {name: _query(name) for name in CASES}
ORACLES = {name: _oracle(cases) for name, (_, cases) in CASES.items()}
