"""The longer expressions that the text of the corruption steps repeats."""

from __future__ import annotations


class Spark:
    @staticmethod
    def at(lst: str, i: str) -> str:
        return f"element_at({lst}, cast({i} as int))"

    @staticmethod
    def filter(lst: str, v: str, body: str) -> str:
        return f"filter({lst}, {v} -> {body})"

    @staticmethod
    def size(lst: str) -> str:
        return f"size({lst})"

    @staticmethod
    def seq(a: str, b: str) -> str:
        return f"sequence({a}, {b})"

    @staticmethod
    def slice(lst: str, a: str, n: str) -> str:
        return f"slice({lst}, {a}, {n})"

    @staticmethod
    def array(items: list[str]) -> str:
        return f"array({', '.join(items)})"

    @staticmethod
    def draw(key: str, salt: str) -> str:
        return f"cast(conv(substring(md5(concat({key}, '|{salt}')), 1, 8), 16, 10) as bigint)"

    @staticmethod
    def words(text: str, w: str) -> str:
        return f"filter(split({text}, r'{w}+'), x -> x <> '')"

    @staticmethod
    def strip(text: str, w: str) -> str:
        return f"regexp_replace({text}, r'^{w}+|{w}+$', '')"

    @staticmethod
    def group(text: str, pattern: str, i: int) -> str:
        return f"regexp_extract({text}, r'{pattern}', {i})"

    @staticmethod
    def matches(text: str, pattern: str) -> str:
        return f"rlike({text}, r'{pattern}')"

    @staticmethod
    def edges(text: str, chars: str) -> str:
        return f"btrim({text}, '{chars}')"

    @staticmethod
    def join(lst: str) -> str:
        return f"array_join({lst}, ' ')"

    @staticmethod
    def pinned(relation: str, columns: str) -> str:
        """The columns passed through a generator: later filters are not pushed below it, where they would repeat all steps."""
        return f"select o.* from (select explode(array(struct({columns}))) as o from ({relation}) p0) p1"
