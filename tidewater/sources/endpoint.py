"""Relational endpoints: URL, driver, credentials, and the database kind.

The kind (``postgresql``, ``mysql``, ``db2``, ``derby`` or ``generic``) is
taken from the URL prefix and picks the statement templates of the six-mode
writer. URLs may carry ``$host``, ``$db``, ``$user``, ``$password`` and
``$schema`` placeholders, filled in that order; ``$schema`` stays as is when
no schema is set.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# URL templates, drivers and connection parameters of the
# original endpoint configurations (batched statements, UTF-8). Credentials are
# passed as the user/password options rather than in the URL.
POSTGRES_URL = "jdbc:postgresql://$host/$db"
MYSQL_URL = (
    "jdbc:mysql://$host/$db?useUnicode=true&rewriteBatchedStatements=true"
    "&autoReconnect=true&characterEncoding=UTF-8&zeroDateTimeBehavior=round"
)
DB2_URL = "jdbc:db2://$host/$db"
POSTGRES_DRIVER = "org.postgresql.Driver"
MYSQL_DRIVER = "com.mysql.jdbc.Driver"
DB2_DRIVER = "com.ibm.db2.jcc.DB2Driver"
DEFAULT_BATCH_SIZE = 10000
DEFAULT_READ_PARTITIONS = 6

_KINDS = (
    ("jdbc:postgresql:", "postgresql"),
    ("jdbc:mysql:", "mysql"),
    ("jdbc:mariadb:", "mysql"),
    ("jdbc:db2:", "db2"),
    ("jdbc:derby:", "derby"),
)


class EndpointError(ValueError):
    pass


@dataclass(frozen=True)
class Endpoint:
    url: str
    driver: str
    user: str | None = None
    password: str | None = field(default=None, repr=False)
    db: str | None = None
    host: str | None = None
    schema: str | None = None
    properties: dict[str, str] = field(default_factory=dict)

    @classmethod
    def postgres(cls, host: str, db: str, user: str | None = None, password: str | None = None, **kw) -> "Endpoint":
        return cls(POSTGRES_URL, POSTGRES_DRIVER, user, password, db=db, host=host, **kw)

    @classmethod
    def mysql(cls, host: str, db: str, user: str | None = None, password: str | None = None, **kw) -> "Endpoint":
        return cls(MYSQL_URL, MYSQL_DRIVER, user, password, db=db, host=host, **kw)

    @classmethod
    def db2(cls, host: str, db: str, user: str | None = None, password: str | None = None, **kw) -> "Endpoint":
        return cls(DB2_URL, DB2_DRIVER, user, password, db=db, host=host, **kw)

    @classmethod
    def from_config(cls, conf: dict) -> "Endpoint":
        """From a mapping with ``url, driver, user, password, db, host, schema``
        (the fields of the original endpoint configurations)."""
        known = ("url", "driver", "user", "password", "db", "host", "schema")
        missing = [k for k in ("url", "driver") if k not in conf]
        if missing:
            raise EndpointError(f"endpoint config lacks {missing}")
        extra = {k: str(v) for k, v in conf.items() if k not in known}
        return cls(**{k: (None if conf.get(k) is None else str(conf[k])) for k in known if k in conf},
                   properties=extra)

    @property
    def resolved_url(self) -> str:
        url = self.url
        for name in ("host", "db", "user", "password"):
            value = getattr(self, name)
            if value is not None:
                url = url.replace(f"${name}", value)
        if self.schema is not None:
            url = url.replace("$schema", self.schema)
        return url

    @property
    def kind(self) -> str:
        u = self.resolved_url.lower()
        for prefix, kind in _KINDS:
            if u.startswith(prefix):
                return kind
        return "generic"

    def require(self, kind: str) -> "Endpoint":
        """Check that URL and driver both name ``kind`` (catches a MySQL driver
        configured for a DB2 endpoint)."""
        if self.kind != kind:
            raise EndpointError(f"endpoint URL is {self.kind}, expected {kind}")
        if kind not in self.driver.lower():
            raise EndpointError(f"driver {self.driver!r} is not a {kind} driver")
        return self

    def options(self) -> dict[str, str]:
        """Reader/writer options; credentials travel as options, not in the URL."""
        opts = {"url": self.resolved_url, "driver": self.driver}
        if self.user is not None:
            opts["user"] = self.user
        if self.password is not None:
            opts["password"] = self.password
        opts.update(self.properties)
        return opts

    def connection_properties(self) -> dict[str, str]:
        return {k: v for k, v in self.options().items() if k != "url"}
