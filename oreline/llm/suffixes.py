"""Address suffixes of several labels under which anyone registers a name: the common ones of the public suffix list.

A suffix that is not listed counts as its last label. Callers with the whole list pass it instead.
"""

_SECOND = {
    "uk": "ac co gov ltd me net nhs org plc police sch", "au": "asn com edu gov id net org", "nz": "ac co geek gen govt iwi maori net org school",
    "jp": "ac ad co ed go gr lg ne or", "kr": "ac co go ne or pe re", "cn": "ac com edu gov net org", "tw": "com edu gov idv net org", "hk": "com edu gov idv net org",
    "sg": "com edu gov net org per", "my": "com edu gov name net org", "id": "ac co go or sch web my", "th": "ac co go in or", "vn": "com edu gov net org", "ph": "com edu gov net org",
    "in": "ac co edu firm gen gov ind net nic org res", "pk": "com edu gov net org", "bd": "com edu gov net org", "lk": "com edu gov org", "il": "ac co gov muni net org",
    "tr": "av bel biz com edu gen gov info k12 name net org web", "sa": "com edu gov net org", "ae": "ac co gov net org", "eg": "com edu gov net org", "za": "ac co gov net org web",
    "ke": "ac co go ne or", "ng": "com edu gov net org", "gh": "com edu gov org", "br": "art blog com edu eco gov jus leg mil net org", "ar": "com edu gob gov net org", "mx": "com edu gob net org",
    "co": "com edu gov net nom org", "pe": "com edu gob net org", "ve": "co com edu gob net org", "ec": "com edu gob net org", "uy": "com edu gub net org", "ua": "com edu gov in net org kiev",
    "pl": "com edu gov info net org waw", "ru": "com msk net org spb", "gr": "com edu gov net org", "pt": "com edu gov org", "es": "com edu gob nom org", "hu": "co info org", "ro": "com info org",
    "at": "ac co gv or", "fr": "asso com gouv nom", "it": "edu gov",
}
_HOSTED = """
    github.io gitlab.io blogspot.com wordpress.com herokuapp.com netlify.app vercel.app pages.dev workers.dev web.app
    firebaseapp.com appspot.com azurewebsites.net cloudfront.net s3.amazonaws.com readthedocs.io neocities.org
    weebly.com wixsite.com tumblr.com substack.com myshopify.com
""".split()

SUFFIXES: tuple[str, ...] = tuple(sorted([*(f"{second}.{top}" for top, names in _SECOND.items() for second in names.split()), *_HOSTED]))
