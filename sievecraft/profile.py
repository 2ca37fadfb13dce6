"""What a compilation aims at, and the fixed values of the rule language and the target format."""

from __future__ import annotations

from dataclasses import dataclass

# ---------------------------------------------------------------- fixed values
# The names, patterns and limits below are given by the rule language and by the
# target's parser; they must be exactly these for results to be right.

#: Most rules that one output file may hold.
MAX_RULES = 150_000

#: Request types of rules, and what they are called in triggers.
TYPES = {
    "document": "document", "subdocument": "document", "image": "image", "stylesheet": "style-sheet", "script": "script", "font": "font",
    "media": "media", "xmlhttprequest": "fetch", "websocket": "websocket", "ping": "ping", "beacon": "ping", "other": "other",
    "object": "other", "object-subrequest": "other", "popup": "popup",
}
LEGACY_RAW = ("xmlhttprequest", "websocket", "ping", "beacon", "other", "object", "object-subrequest")
ALL_TYPES = ("document", "image", "style-sheet", "script", "font", "media", "popup", "fetch", "websocket", "ping", "other", "svg-document")
ALL_TYPES_LEGACY = ("document", "image", "style-sheet", "script", "font", "media", "popup", "raw", "svg-document")

ALIASES = {
    "xhr": "xmlhttprequest", "css": "stylesheet", "frame": "subdocument", "doc": "document", "ghide": "generichide", "ehide": "elemhide",
    "shide": "specifichide", "from": "domain", "3p": "third-party", "1p": "first-party", "popunder": "popup", "queryprune": "removeparam",
    "object-subrequest": "object", "beacon": "ping", "xhr-request": "xmlhttprequest",
}

UNSUPPORTED = frozenset(
    "csp redirect redirect-rule removeparam removeheader replace hls jsonprune permissions referrerpolicy method to header app network "
    "extension stealth webrtc empty mp4 inline-script inline-font genericblock generichide elemhide jsinject content urlblock badfilter "
    "specifichide strict-first-party strict-third-party cookie stealth-mode ctag dnstype client path url urlskip uritransform strict3p "
    "strict1p reason ipaddress cname websocket-request match-case-value".split()
)
IGNORED = frozenset({"important", "all", "not-important"})
PARTIAL = frozenset({"generichide", "elemhide", "specifichide", "urlblock", "jsinject", "content", "extension"})
METHODS = frozenset("get head options trace put delete post patch connect".split())
#: DNS answers (in lower case) that block a host: addresses and names, codes, and records of an empty address.
DNS_BLACKHOLE = (
    r"^\s*(?:|0\.0\.0\.0|::|127\.0\.0\.1|::1|nxdomain|refused|ad-block\.dns\.adguard\.com|block\.dns\.adguard\.com)[.\s]*$"
    r"|^[\s;]*(?:nxdomain|refused)\s*;"
    r"|^[\s;]*noerror\s*;[\s;]*[^;\s][^;]*;[\s;]*(?:0\.0\.0\.0|::)[.\s;]*$"
)

MARKERS = ("#@$?#", "#@$#", "#@?#", "#@%#", "#@#", "#$?#", "#$#", "#?#", "#%#", "##")
EXTENDED_CSS = (
    ":has-text(", ":contains(", ":matches-css", ":matches-attr", ":matches-path", ":matches-property", ":min-text-length(", ":xpath(",
    ":nth-ancestor(", ":upward(", ":watch-attr(", ":remove()", ":remove(", ":style(", ":-abp-", ":if(", ":if-not(", ":properties(", ":others(", "##^",
)
#: Texts that may stand nowhere in a trigger's expression.
FORBIDDEN = ("{", "}", "(?", "\\d", "\\w", "\\s", "\\D", "\\W", "\\S", "\\b", "\\B", "*?", "+?", "??", "|", "\\1", "\\2", "\\3")

#: What ``name.*`` stands for where the target has no wildcard of top-level domains.
TLDS = (
    "com net org io co to me tv cc xyz top site online info biz club live fun store art one pro vip ws la is in ru ua by kz de fr it es nl "
    "pl pt br mx ar cl pe cn jp kr id vn th tw hk sg my ph se no dk fi cz sk hu ro bg gr tr be ch at ie nz au ca us uk eu dev app link click "
    "space website host press blog cyou icu buzz life world today news media digital cloud network group agency plus best wiki quest sbs shop "
    "lat cfd bond co.uk com.br com.mx com.ar com.tr com.ua com.au co.jp co.kr com.cn"
).split()

HOSTS_LINE = r"^(?:0\.0\.0\.0|127\.0\.0\.1|::1?|::)[ \t]+(\S+)"
LOOPBACK = ("localhost", "localhost.localdomain", "broadcasthost", "local", "0.0.0.0", "ip6-localhost", "ip6-loopback")
DOMAIN = r"^[a-z0-9]([a-z0-9-]*[a-z0-9])?(\.[a-z0-9]([a-z0-9-]*[a-z0-9])?)+\.?$"
TOP_LEVEL = r"^([a-z]{2,63}|xn--[a-z0-9-]{1,59})$"
SCOPE_DOMAIN = r"^[a-z0-9]([a-z0-9_-]*[a-z0-9])?(\.[a-z0-9]([a-z0-9_-]*[a-z0-9])?)*$"

#: ``||``: any scheme of web or socket addresses and any depth of sub-domains.
ANCHOR = r"^[htpsw]+://([a-z0-9-]+\.)*"
ANY_HOST = r"^[htpsw]+://[^/]*"
SITE = r"^[htpsw]+://"
SEP_INNER, SEP_FINAL = r"[/:&?=,;]?", r"[/:&?=,;]"
META = r".+?()[]{}|^$\*"
JS_ANCHOR = r"^[a-z][a-z0-9+.-]*://([^/?#]*\.)?"
JS_SEPARATOR = r"(?:[^\w.%-]|$)"
JS_HEAD = r"^[a-z][a-z0-9+.-]*://[^/?#]*"

#: Limits of expressions.
MAX_VARIANTS, MAX_EXPANDED, MAX_ANY_REPEAT, MAX_SELECTOR = 24, 1500, 8, 1024

TRIGGER_KEYS = (
    "url-filter", "url-filter-is-case-sensitive", "resource-type", "load-context", "load-type", "request-method",
    "if-frame-url", "unless-frame-url", "if-domain", "unless-domain", "if-top-url", "unless-top-url",
)
CONDITIONS = ("if-domain", "unless-domain", "if-top-url", "unless-top-url", "if-frame-url", "unless-frame-url")
ACTIONS = ("block", "block-cookies", "css-display-none", "ignore-previous-rules", "make-https")

#: The side table's own names of request types and parties.
ANNEX_TYPES = {
    "script": "script", "image": "image", "stylesheet": "stylesheet", "css": "stylesheet", "xmlhttprequest": "xhr", "xhr": "xhr", "fetch": "xhr",
    "media": "media", "font": "font", "subdocument": "frame", "frame": "frame", "document": "document", "doc": "document", "object": "object",
    "ping": "ping", "websocket": "websocket", "other": "other", "popup": "popup",
}
THIRD, FIRST = ("third-party", "3p", "strict3p"), ("first-party", "1p", "strict1p")
ANNEX_HARMLESS = ("important", "all", "match-case", "badfilter")
FAMILIES = ("redirect", "redirect-rule", "removeparam", "queryprune", "urlskip", "csp", "cookie", "replace")

#: Names that are true in directives of lists.
PREPROCESSOR_ENV = frozenset({"env_safari", "adguard_ext_safari", "adguard"})
# ----------------------------------------------------------- end of fixed values

#: Spark types of a rule; an absent key is null.
TRIGGER_DDL = "struct<" + ", ".join(
    f"`{k}`: " + ("boolean" if k.endswith("sensitive") else "string" if k in ("url-filter", "request-method") else "array<string>") for k in TRIGGER_KEYS
) + ">"

#: Sections of an output, in their order.
BUCKETS = ("generic_css", "generichide", "block", "guard", "block_document", "cookie", "urlblock", "specific_css", "exception", "page_exception")
BUCKET = {name: i for i, name in enumerate(BUCKETS)}
TAIL = BUCKET["exception"]


@dataclass(frozen=True)
class Profile:
    """The knobs of a compilation."""

    legacy: bool = False
    document_policy: str = "guard"  # guard, enumerate or allow
    allow_has: bool = True
    css_group_size: int = 250
    keep_extended: bool = True
    safari_version: int = 26
    min_rules: int = 10
    min_yield: float = 0.01
    max_rules: int = MAX_RULES

    @property
    def policy(self) -> str:
        return "enumerate" if self.legacy and self.document_policy == "guard" else self.document_policy

    @property
    def frames(self) -> bool:
        """Whether triggers may have frame conditions and methods."""
        return not self.legacy and self.safari_version >= 26

    @property
    def types(self) -> dict[str, str]:
        return {k: "raw" if k in LEGACY_RAW else v for k, v in TYPES.items()} if self.legacy else TYPES

    @property
    def all_types(self) -> tuple[str, ...]:
        return ALL_TYPES_LEGACY if self.legacy else ALL_TYPES
