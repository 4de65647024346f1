"""The feed as one document, and landed pages and feeds as data sources.

``feed_document`` composes channel and items with Spark's XML functions and works on any file system.  The data sources ``landed_pages`` and
``paper_feed`` are Python data sources: their tasks open files themselves, so the folder must be mounted at the same path on
all machines.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterator
from dataclasses import asdict, dataclass
from pathlib import Path
from xml.etree import ElementTree
from xml.sax.saxutils import escape

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceStreamReader,
    DataSourceWriter,
    InputPartition,
    WriterCommitMessage,
)

ITEM = "title string, link string, guid string, pubDate string, description string"
FIELDS = [f.split()[0] for f in ITEM.split(", ")]
ATOM = "http://www.w3.org/2005/Atom"
DECLARATION = '<?xml version="1.0" encoding="UTF-8"?>\n'


@dataclass(frozen=True)
class Channel:
    """What a feed says about itself.  ``site`` is its address without a slash at the end."""

    title: str
    site: str
    description: str
    language: str = "en"
    file_name: str = "feed.xml"
    minutes: int = 720


def feed_document(items: DataFrame, channel: Channel, built: Column, order: list[Column], ascending: bool = True) -> DataFrame:
    """One row, ``xml``: the channel's header and its items in order.  ``items`` is a feed, a few dozen rows; without any the header stands alone.

    ``built`` is the build date as text.  Markup characters are escaped by the writer, a guid is the item's permanent address.
    """
    places = [c.alias(f"_o{i}") for i, c in enumerate(order)]
    ranked = items.select(F.struct(*places).alias("_place"), *FIELDS)
    item = F.struct("title", "link", F.struct(F.lit("true").alias("_isPermaLink"), F.col("guid").alias("_VALUE")).alias("guid"), "pubDate", "description")
    rows = F.transform(F.sort_array(F.collect_list(F.struct("_place", item.alias("_item"))), ascending), lambda r: r["_item"])
    head = [F.lit(channel.title).alias("title"), F.lit(f"{channel.site}/").alias("link"),
            F.lit(channel.description).alias("description"), F.lit(channel.language).alias("language"), built.alias("lastBuildDate"),
            F.lit(str(channel.minutes)).alias("ttl")]
    whole = ranked.agg(rows.alias("item"))
    inner = F.to_xml(F.struct(*head, "item"), {"rowTag": "channel"})
    own = f'<channel>\n    <atom:link href="{escape(channel.site)}/{channel.file_name}" rel="self" type="application/rss+xml"/>'
    inner = F.replace(inner, F.lit("<channel>"), F.lit(own))  # texts are escaped, so the tag is there once; the writer takes no names with a colon
    return whole.select(F.concat(F.lit(f'{DECLARATION}<rss version="2.0" xmlns:atom="{ATOM}">\n'), inner, F.lit("\n</rss>\n")).alias("xml"))


def write_feed_document(document: DataFrame, path: str) -> None:
    """One text file under ``path``."""
    document.coalesce(1).write.mode("overwrite").option("lineSep", "\n").text(path)


def read_feed_items(spark: SparkSession, path: str) -> DataFrame:
    """The items of a feed document, guid as text."""
    schema = ITEM.replace("guid string", "guid struct<_VALUE: string, _isPermaLink: string>")
    rows = spark.read.schema(schema).option("rowTag", "item").format("xml").load(path)
    return rows.withColumn("guid", F.col("guid._VALUE")).select(*FIELDS)


# --- landed pages


@dataclass(frozen=True)
class PageFiles(InputPartition):
    names: tuple[str, ...]


def _landed(path: str) -> list[tuple[int, str]]:
    """Time in nanoseconds and name of the files that have landed, oldest first.  Files whose name begins with a dot or underscore are not there yet."""
    return sorted((entry.stat().st_mtime_ns, entry.name) for entry in os.scandir(path) if entry.is_file() and entry.name[0] not in "._")


def _pages(path: str, names: tuple[str, ...]) -> Iterator[tuple[str, str]]:
    for name in names:
        yield name, Path(path, name).read_text(encoding="utf-8", errors="replace")


def _dealt(names: list[str], most: int) -> list[PageFiles]:
    return [PageFiles(tuple(names[i:i + most])) for i in range(0, len(names), most)]


class PageReader(DataSourceReader):
    def __init__(self, path: str, most: int):
        self.path, self.most = path, most

    def partitions(self) -> list[PageFiles]:
        return _dealt([name for _, name in _landed(self.path)], self.most) or [PageFiles(())]

    def read(self, partition: PageFiles) -> Iterator[tuple[str, str]]:
        return _pages(self.path, partition.names)


class PageStream(DataSourceStreamReader):
    """An offset is the time and name of the newest file taken; a batch is what lies between two offsets, so a replay reads the same files.

    Files must be moved into the folder when they are complete, which gives them a later time than those that were there.
    """

    def __init__(self, path: str, most: int):
        self.path, self.most = path, most

    def initialOffset(self) -> dict:
        return {"time": -1, "name": ""}

    def latestOffset(self) -> dict:
        files = _landed(self.path)
        return {"time": files[-1][0], "name": files[-1][1]} if files else self.initialOffset()

    def partitions(self, start: dict, end: dict) -> list[PageFiles]:
        low, high = (start["time"], start["name"]), (end["time"], end["name"])
        return _dealt([name for at, name in _landed(self.path) if low < (at, name) <= high], self.most) or [PageFiles(())]

    def read(self, partition: PageFiles) -> Iterator[tuple[str, str]]:
        return _pages(self.path, partition.names)

    def commit(self, end: dict) -> None:
        pass


class LandedPages(DataSource):
    """``spark.read.format("landed_pages").load(folder)``, the same with ``readStream``.  Option ``filesPerTask``."""

    @classmethod
    def name(cls) -> str:
        return "landed_pages"

    def schema(self) -> str:
        return "url string, html string"

    def _most(self) -> int:
        return int(self.options.get("filesPerTask", "64"))

    def reader(self, schema) -> PageReader:
        return PageReader(self.options["path"], self._most())

    def streamReader(self, schema) -> PageStream:
        return PageStream(self.options["path"], self._most())


# --- feeds


@dataclass
class Written(WriterCommitMessage):
    name: str


class FeedWriter(DataSourceWriter):
    """Tasks write their items beside the feed; the commit puts them in order under the channel's header and swaps the file in by one rename.

    A commit that fails or a task that is lost leaves the old feed as it was; what tasks left behind goes with the next commit.
    """

    def __init__(self, path: str, channel: Channel, built: str):
        self.path, self.channel, self.built, self.run = path, channel, built, uuid.uuid4().hex

    def _parts(self) -> Path:
        return Path(self.path).parent / f".{Path(self.path).name}.parts"

    def write(self, rows: Iterator) -> Written:
        folder = self._parts() / self.run
        folder.mkdir(parents=True, exist_ok=True)
        name = str(folder / uuid.uuid4().hex)
        with open(name, "w", encoding="utf-8") as out:
            for row in rows:
                out.write(json.dumps([row[0], *[row[f] for f in FIELDS]], ensure_ascii=False) + "\n")
        return Written(name)

    def commit(self, messages: list[Written | None]) -> None:
        items = [json.loads(line) for m in messages if m is not None for line in Path(m.name).read_text(encoding="utf-8").splitlines()]
        items.sort(key=lambda x: x[0])
        draft = Path(f"{self.path}.{self.run}")
        draft.write_text(feed_text(self.channel, self.built, [dict(zip(FIELDS, x[1:])) for x in items]), encoding="utf-8")
        os.replace(draft, self.path)
        for part in sorted(self._parts().rglob("*"), reverse=True):
            part.rmdir() if part.is_dir() else part.unlink()

    def abort(self, messages: list[Written | None]) -> None:
        for m in messages:
            if m is not None:
                Path(m.name).unlink(missing_ok=True)


def feed_text(channel: Channel, built: str, items: list[dict]) -> str:
    def tag(name: str, value: str | None, attributes: str = "") -> str:
        return f"<{name}{attributes}>{escape(value or '')}</{name}>"

    head = [tag("title", channel.title), tag("link", f"{channel.site}/"),
            f'<atom:link href="{escape(channel.site)}/{channel.file_name}" rel="self" type="application/rss+xml"/>',
            tag("description", channel.description), tag("language", channel.language), tag("lastBuildDate", built), tag("ttl", str(channel.minutes))]
    body = ["<item>" + "".join(tag(f, item[f], ' isPermaLink="true"' if f == "guid" else "") for f in FIELDS) + "</item>" for item in items]
    lines = "\n".join(f"    {x}" for x in head + body)
    return f'{DECLARATION}<rss xmlns:atom="{ATOM}" version="2.0">\n  <channel>\n{lines}\n  </channel>\n</rss>\n'


class FeedReader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def read(self, partition) -> Iterator[tuple]:
        for place, item in enumerate(ElementTree.parse(self.path).getroot().iterfind("channel/item")):
            yield (place, *[item.findtext(f) for f in FIELDS])


class PaperFeed(DataSource):
    """``df.write.format("paper_feed").mode("overwrite").options(**channel_options(channel, built)).save(file)``, and ``spark.read`` for its items.

    Rows have ``place`` and the fields of an item; ``place`` gives the order.
    """

    @classmethod
    def name(cls) -> str:
        return "paper_feed"

    def schema(self) -> str:
        return f"place int, {ITEM}"

    def reader(self, schema) -> FeedReader:
        return FeedReader(self.options["path"])

    def writer(self, schema, overwrite: bool) -> FeedWriter:
        if not overwrite:
            raise ValueError("a feed is written as a whole: use mode('overwrite')")
        given = {k.lower(): v for k, v in self.options.items()}
        fields = {name: type(default)(given[name]) if name in given else default for name, default in asdict(Channel("", "", "")).items()}
        return FeedWriter(given["path"], Channel(**fields), given.get("built", ""))


def channel_options(channel: Channel, built: str) -> dict[str, str]:
    return {k: str(v) for k, v in asdict(channel).items()} | {"built": built}


def register(spark: SparkSession) -> None:
    spark.dataSource.register(LandedPages)
    spark.dataSource.register(PaperFeed)
