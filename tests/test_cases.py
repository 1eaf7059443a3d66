"""Cases of reports that hold whole documents, against a plain loop."""

import re

from briefwright.functions import markdown as M
from catalog import load, periods

SF = "/root/testdata/sf0.001"
DETAILS = ("原文：", "链接：", "链接/作者：", "作者/链接：", "提示：", "摘要：")


def clean(text):
    text = re.sub(r"^\d+\.\s*", "", re.sub(r"^[-*]\s+", "", text.strip()))
    text = re.sub(r"https?://\S+", "", re.sub(r"\[([^\]]+)\]\((https?://[^)]+)\)", r"\1", text))
    text = re.sub(r"^高亮[:：]?\s*", "", text.replace("**", "").replace("`", ""))
    text = re.sub(r"(原文|链接|讨论|详情|技术报告|Link|更多信息)[:：].*$", "", text, flags=re.I)
    text = re.sub(r"(—\s*Link|。链接|链接)$", "", text, flags=re.I)
    text = re.sub(r"\([^()]{1,20}\)$", "", re.sub(r"（[^（）]{1,20}）$", "", text))
    return re.sub(r"\s+", " ", text).strip(" -：:;；，。,")


def first_url(text):
    urls = [u.rstrip("),.，。;；]）") for u in re.findall(r"https?://[^\s\u3000)）\]】,，;；]+", text)]
    return next((u for u in urls if u), "")


def brute(md):
    """(title, url, section, snippet) of each case, by one pass over the lines."""
    out, section, case = [], "", None

    def flush():
        if case and case[0] and case[1] and not section.lower().startswith("platform statistics"):
            out.append((*case[:2], section, case[2]))

    for raw in md.splitlines():
        line, bare = raw.rstrip(), raw.strip()
        head = re.match("#{2,3} ", bare)
        if head:
            flush()
            case, section = None, bare[head.end():].strip()
        elif bare and not bare.startswith("|"):
            if re.match(r"^\s*(?:- |\d+\.\s+)", line) and not re.match(r"^\s{2,}-\s+", line):
                flush()
                title = clean(bare)
                case = None if title.startswith(DETAILS) else [title, first_url(bare), ""]
            elif case:
                if not case[1] and first_url(bare) and any(t in bare for t in ("原文", "链接", "作者", "详见", "详情")):
                    case[1] = first_url(bare)
                elif not case[2] and any(t in bare for t in ("摘要：", "提示：", "总结", "简述")):
                    case[2] = re.sub(r"^[-*]\s*", "", bare)
    flush()
    return out


def listed(rows):
    return sorted((r.report_id, r.title, r.url, r.section, r.snippet) for r in rows)


def test_all_cases_of_whole_documents(spark):
    texts = {r.report_id: (r.markdown, r.text) for r in periods.reports(spark, SF).collect()}
    assert len(texts) == spark.read.parquet(f"{SF}/documents.parquet").count() and all((text or "") in md for md, text in texts.values())
    want = sorted((key, *case) for key, (md, _) in texts.items() for case in brute(md))
    got = listed(load().QUERIES["st34_case_extraction_whole"](spark, SF).collect())
    assert got == want and {g[0] for g in got} == set(texts) and any(not g[1].startswith("Second ") for g in got)


def test_hard_documents(spark):
    frame = "# D\n## 1. Top\n- **[%s](https://a.example/1)** （来源）\n  - 摘要：short\n2. Second x item\n  - 原文：https://b.example/2。\n  - 提示：later"
    hard = ["a\nb", "a [b] (c)", "x: y*z", "l\n## s\n- t https://c.example/3, q\nz", "链接：x", "1. one\n2. two\n  总结 three\n原文 https://d.example/4）", "（更多）", "| t", "- https://e.example/5\n\n详情 https://f.example/6"]
    docs = [(str(i), frame % h) for i, h in enumerate(hard)]
    got = listed(M.extract_cases(spark.createDataFrame(docs, "report_id string, markdown string")).collect())
    assert got == sorted((key, *case) for key, md in docs for case in brute(md))
