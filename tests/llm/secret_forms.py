"""Forms of secrets and of what looks like them that no forest has learnt, in the notation of ``secrets.FORMS``."""

HELD_OUT = (
    (1, "set <glpat-{a:20}> here"),
    (1, "clone with <github_pat_{a:22}_{a:59}> now"),
    (1, "login <npm_{a:36}> first"),
    (1, "mail by <SG.{a:22}.{a:43}> works"),
    (1, "STRIPE_KEY=<rk_live_{a:24}> is"),
    (1, "password = <{a:16}> is"),
    (1, "PGPASSWORD=<{a:13}> psql"),
    (1, "{{\"user\":\"{w}\",\"secret\":\"<{p:14}>\"}} as"),
    (1, "login_password=<{w}{w2}{w3}> in"),
    (1, "admin password is set: password='<{p:10}>' so"),
    (1, "at redis://:<{a:16}>@cache:6379 is"),
    (1, "at mongodb+srv://app:<{a:18}>@cluster0.abc.mongodb.net/{w} is"),
    (1, "at ftp://{w}:<{l:9}>@{w2}.net/ is"),
    (1, "private_key_id: <{h:40}> in"),
    (1, "auth_token: <{h:32}> in"),
    (1, "X-Api-Key: <{a:27}> goes"),
    (1, "smtp_pwd: <{l:12}> in"),
    (1, "credential=<{u:24}> of"),
    (1, "get https://{w}.io/?access_key=<{a:30}>&page={d:2} then"),
    (0, "part {c:3}-{d:4}-{c:6} in"),
    (0, "spare PN{d:6}-{c:3}{d:2} in"),
    (0, "a Galaxy{W}{d:2}Ultra{d:3}GB has"),
    (0, "an iPhone{d:2}ProMax{d:3}GB has"),
    (0, "agent Firefox/{d:3}.0.{d:1}esr-linux64 has"),
    (0, "build 2024.{d:2}.{d:5}-stable of"),
    (0, "git rev {h:40} of"),
    (0, "fingerprint {h:2}:{h:2}:{h:2}:{h:2}:{h:2}:{h:2}:{h:2}:{h:2} of"),
    (0, "doi:10.1000/{d:6}.{d:4} says"),
    (0, "arXiv:{d:4}.{d:5}v2 says"),
    (0, "tel +49-{d:3}-{d:7} or"),
    (0, "order #{d:3}-{d:7}-{d:7} of"),
    (0, "user {W}{W2}{d:4} wrote"),
    (0, "in /usr/lib/{w}/{w2}-{d:1}.{d:2}.so.{d:1} of"),
    (0, "IMG_{d:8}_{d:6}.jpg of"),
    (0, "id {h:8}-{h:4}-1{h:3}-{h:4}-{h:12} of"),
    (0, "ISO{d:5}-{d:1}-2019 says"),
    (0, "RFC{d:4}-section{d:1} says"),
    (0, "license MIT-{d:4}-{w} of"),
    (0, "the password: {w} must"),
    (0, "token={w}.{w2}() in"),
    (0, "secret = {w}_{w2}_{w3} in"),
    (0, "api_key=sample{w}{d:3} in"),
    (0, "passwords: forgotten or"),
    (0, "see https://{w}.net/{d:4}/{d:2}/{w2}-{w3}-{d:5}.html in"),
    (0, "invoice {c:3}-{d:8} of"),
    (0, "item {c:2}{d:3}{c:2}{d:4} of"),
)
