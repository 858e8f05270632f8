"""Frozen settings of each stage; every vocabulary is a parameter."""

from __future__ import annotations

import dataclasses
import json
import os
from dataclasses import dataclass


@dataclass(frozen=True)
class Cleaning:
    question_fields: tuple[str, ...] = tuple("question query prompt ask title".split())
    answer_fields: tuple[str, ...] = tuple("answer response output completion reply".split())
    instruction_fields: tuple[str, ...] = ("instruction",)
    input_fields: tuple[str, ...] = ("input",)
    output_fields: tuple[str, ...] = ("output",)
    conversation_fields: tuple[str, ...] = ("conversations", "messages")
    user_roles: tuple[str, ...] = tuple("human user 患者 病人".split())
    assistant_roles: tuple[str, ...] = tuple("gpt assistant doctor 医生 客服".split())
    ad_keywords: tuple[str, ...] = tuple("代理 免费咨询 加微信 微信号 扫码 推广 私聊 联系电话".split())
    contact_patterns: tuple[str, ...] = (
        r"1[3-9][0-9]{9}",
        r"[a-z0-9._%+-]+@[a-z0-9.-]+\.[a-z]{2,}",
        r"(?:vx|qq|微信)[:：]?[a-z0-9_-]{5,}",
        r"www\.[^\s]+",
        r"https?://[^\s]+",
    )
    min_question: int = 4
    max_question: int = 2048
    min_answer: int = 10
    max_answer: int = 8192
    dedup: bool = True
    default_instruction: str = "请回答以下医疗问题"
    #: The ad filter sees instruction, input and output; with ``parity`` a row without input shows it only the output.
    parity: bool = False


@dataclass(frozen=True)
class Similarity:
    template: str = "\n".join(f"{label}：{{{name}}}" for label, name in zip("指令 问题 回答".split(), "instruction input output".split(), strict=True))
    #: True leaves backslash-n in the template as two characters.
    literal_escapes: bool = False
    dim: int = 384
    top_k: int = 100_000
    decimals: int = 8


@dataclass(frozen=True)
class Scoring:
    sections: tuple[str, ...] = tuple("病情分析 处理建议 风险提示 就医建议".split())
    positive: tuple[str, ...] = tuple("不能替代医生诊断 医生指导 医生评估 及时就医 完善检查 急诊 面诊".split())
    negative: tuple[str, ...] = tuple("一定不是 不用就医 不用检查 保证治愈 无需就医 自行停药 自行用药 随便吃药".split())
    prompt_risk: tuple[str, ...] = tuple("中毒 休克 儿童 出血 卒中 呼吸困难 婴儿 孕妇 心梗 昏迷 胸痛".split())
    diagnosis: str = "诊断"
    safeguards: tuple[str, ...] = ("医生", "检查")
    weights: tuple[float, float, float] = (0.30, 0.50, 0.20)


@dataclass(frozen=True)
class Cases:
    #: Default values; the order of hints, then risk terms, decides ties between keywords.
    risk_terms: tuple[str, ...] = tuple("胸痛 心梗 心肌梗死 卒中 中风 脑梗 脑出血 出血 呼吸困难 窒息 昏迷 休克 抽搐 惊厥 高热 感染性休克 孕妇 妊娠 儿童 婴儿 新生儿 老人 老年 肿瘤 癌 白血病 糖尿病酮症 过敏性休克 自杀 中毒 急腹症".split())
    hints: tuple[str, ...] = tuple("诊断 治疗 检查 症状 病因 并发症 预防 用药 手术 心电图 肌钙蛋白 血常规 影像 CT MRI 感染 炎症 综合征 梗死 肿瘤 贫血 糖尿病 高血压 抗生素 激素".split())
    stopwords: tuple[str, ...] = tuple("一种 下列 什么 以下 以及 可以 哪些 如何 如果 导致 怎么 患者 或者 描述 疾病 病人 进行 需要".split())
    size: int = 5000
    seed: int = 42
    high_share: float = 0.30
    keywords: int = 8


FORMAT_INSTRUCTION = "请严格按照以下四个小标题回答：\n" + "".join(f"{i}. {s}\n" for i, s in enumerate(Scoring().sections, 1)) + "\n病例问题："


def scalar(text: str):
    """A YAML scalar: quoted string (with escapes if in double quotes), list, boolean, integer, float or bare string."""
    text = text.strip()
    if len(text) > 1 and text[0] == text[-1] == '"':
        return json.loads(text)
    if len(text) > 1 and text[0] == text[-1] == "'":
        return text[1:-1].replace("''", "'")
    if text.startswith("[") and text.endswith("]"):
        return tuple(scalar(x) for x in text[1:-1].split(",") if x.strip())
    for kind in (int, float):
        try:
            return kind(text)
        except ValueError:
            pass
    return {"true": True, "false": False, "null": None, "": None}.get(text.lower(), text)


def load(kind: type, path: str | None = None, **overrides):
    """Defaults < file (JSON, or flat YAML with scalars, [lists] and "- item" blocks) < overrides; a missing file is none, an unknown key an error."""
    found: dict = {}
    if path and os.path.exists(path):
        with open(path, encoding="utf-8") as f:
            body = f.read()
        if path.endswith(".json"):
            found = json.loads(body)
        else:
            key = None
            for line in body.splitlines():
                if not line.strip() or line.lstrip().startswith("#"):
                    continue
                if line.lstrip().startswith("- ") and key:
                    found[key] = (*(found[key] or ()), scalar(line.lstrip()[2:].split(" #")[0]))
                else:
                    key, _, value = line.partition(":")
                    key = key.strip()
                    found[key] = scalar(value.split(" #")[0])
    found |= {k: v for k, v in overrides.items() if v is not None}
    known = {f.name for f in dataclasses.fields(kind)}
    if unknown := set(found) - known:
        raise ValueError(f"unknown settings: {sorted(unknown)}")
    return kind(**{k: tuple(v) if isinstance(v, list) else v for k, v in found.items()})
