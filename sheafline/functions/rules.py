"""Ordered rewrite rules over page text: a general layer, a layer of an organisation's terms, and the user's own.

Each layer is a table of (pattern, replacement) folded into one Column; the order of a table is part of its meaning.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import clean_line, clean_text, col, let, sub

# ---- fixed values -------------------------------------------------------------------------------------------------
# Glyphs that text layers and scanners produce, and what they become.
GLYPHS = (("●", "•"), ("·", "•"), ("▪", "•"), ("\uf0a7", "•"), ("\uf02d", "-"), ("—", "–"), ("−", "-"), ("„", "“"), ("‟", "”"))

# Common misreadings in administrative texts, in order.
GENERAL = (
    (r"\bCăn\s+cử\b", "Căn cứ"),
    (r"\bCăn\s+củ\b", "Căn cứ"),
    (r"\bCăn\s+cửu\b", "Căn cứ"),
    (r"\btin dụng\b", "tín dụng"),
    (r"\btin\s+dụng\b", "tín dụng"),
    (r"\bđảo tạo\b", "đào tạo"),
    (r"\bĐào tào\b", "Đào tạo"),
    (r"\bđề\s+giải ngân\s+v[ôo]n\s+vay\b", "để giải ngân vốn vay"),
    (r"\bđề\s+hỗ trợ\b", "để hỗ trợ"),
    (r"\bkỳ han\b", "kỳ hạn"),
    (r"\bkỳ hạrn\b", "kỳ hạn"),
    (r"\bv[ôo]n vay\b", "vốn vay"),
    (r"\btỉnh hình\b", "tình hình"),
    (r"\bthay döi\b", "thay đổi"),
    (r"\bnganh, linh vuc\b", "ngành, lĩnh vực"),
    (r"\bnghi học\b", "nghỉ học"),
    (r"\bđóng dầu\b", "đóng dấu"),
    (r"\bnghiện cứu sinh\b", "nghiên cứu sinh"),
    (r"\bnghi[êe]n cứu sinh\b", "nghiên cứu sinh"),
    (r"\bthạc sỹ\b", "thạc sĩ"),
    (r"\bhọc bồng\b", "học bổng"),
    (r"\bđỉnh kèm\b", "đính kèm"),
    (r"\bkhoá học\b", "khóa học"),
    (r"\bviệt nam\b", "Việt Nam"),
    (r"\bnhà nước việt nam\b", "Nhà nước Việt Nam"),
    (r"\bngân hàng nhà nước việt nam\b", "Ngân hàng Nhà nước Việt Nam"),
    (r"\bbộ tài chính\b", "Bộ Tài chính"),
    (r"\bbộ giáo dục và đào tạo\b", "Bộ Giáo dục và Đào tạo"),
    (r"\bngân hàng chính sách xã hội\b", "Ngân hàng Chính sách xã hội"),
    (r"\bngân hàng chính sách xả hội\b", "Ngân hàng Chính sách xã hội"),
    (r"\bThủ tướng chính phủ\b", "Thủ tướng Chính phủ"),
    (r"\bphó thủ tướng chính phủ\b", "Phó Thủ tướng Chính phủ"),
    (r"\bchính phủ\b", "Chính phủ"),
    (r"\bCộng hòa xã hội chủ nghĩa việt nam\b", "Cộng hòa xã hội chủ nghĩa Việt Nam"),
    (r"\bCọng hòa xã hội chủ nghĩa việt nam\b", "Cộng hòa xã hội chủ nghĩa Việt Nam"),
    (r"\bCÒ G HÒA XÃ HỘI CHỦ NGHĨA VIỆT NAM\b", "CỘNG HÒA XÃ HỘI CHỦ NGHĨA VIỆT NAM"),
    (r"\bDai hoc\b", "Đại học"),
    (r"\bDẠI HỌC\b", "ĐẠI HỌC"),
    (r"\bCan Tho\b", "Cần Thơ"),
    (r"\bCAN THO\b", "CẦN THƠ"),
    (r"\bQuyet dinh\b", "Quyết định"),
    (r"\bQUYET DINH\b", "QUYẾT ĐỊNH"),
    (r"\bThong bao\b", "Thông báo"),
    (r"\bTHONG BAO\b", "THÔNG BÁO"),
    (r"\bSinh vien\b", "Sinh viên"),
    (r"\bSINH VIEN\b", "SINH VIÊN"),
    (r"\bHoc vu\b", "Học vụ"),
    (r"\bHOC VU\b", "HỌC VỤ"),
    (r"\bCong tac sinh vien\b", "Công tác sinh viên"),
    (r"\bCONG TAC SINH VIEN\b", "CÔNG TÁC SINH VIÊN"),
    (r"\bPhong Dao tao\b", "Phòng Đào tạo"),
    (r"\bDao tao\b", "Đào tạo"),
    (r"\bHieu truong\b", "Hiệu trưởng"),
    (r"\bUu tiên\b", "Ưu tiên"),
    (r"\bM[ẪÃA]U\s+2\s+Ở\s+KÍ:?\s+AI\s+THÔNG\s+TIN\b", "MẪU TỜ KHAI THÔNG TIN"),
    (r"\bMAU\s+T[OỜ]\s+KHAI\b", "MẪU TỜ KHAI"),
    (r"\bNGÂN\s+JANG\s+CHÍNH\s+SÁCH\s+XÃ\s+HỘI\b", "NGÂN HÀNG CHÍNH SÁCH XÃ HỘI"),
    (r"\bTỜ\s+KHAI\s+THÔNG\s+TIN\s+HẰNG\s+NÃM\b", "TỜ KHAI THÔNG TIN HẰNG NĂM"),
    (r"\bMÀ\s+50\s*-U.*?THÔNG\s+TIN\s+HÀNG\s+NĂM\s+CỦA\s+NGƯỜI\s+HỌC\b", "MẪU TỜ KHAI THÔNG TIN HẰNG NĂM CỦA NGƯỜI HỌC"),
    (r"\bCCCD\s+số\b", "CCCD số"),
    (r"\bCCD\s+số\b", "CCCD số"),
    (r"\bngày cấp\b", "ngày cấp"),
)

# Abbreviations that lose the space after them, and pairs of words that lose the one between them.
ABBREVIATIONS = ("CTSV", "ĐRL", "CVHT", "QĐ", "BGH", "SV", "CTCT", "KHTH", "SQDB", "TTGDQP", "QK9")
GLUED = (
    (r"\b(Khoa)(tổng|thông|xét|cấp)\b", "$1 $2"),
    (r"\b(Phòng)(CTSV|CTCT|Đào tạo|KHTH)\b", "$1 $2"),
    (r"\b(PhòngCTSV)\b", "Phòng CTSV"),
    (r"\b(đơn vị)(quản lý|đào tạo)\b", "$1 $2"),
    (r"\b(sinh viên)(đang|nhận|dự|có)\b", "$1 $2"),
)

# Terms without their diacritics, in order, then abbreviations in their usual form.
TERMS = (
    (r"\bDai hoc Can Tho\b", "Đại học Cần Thơ"),
    (r"\bDẠI HỌC CẦN THO\b", "ĐẠI HỌC CẦN THƠ"),
    (r"\bDai Hoc Can Tho\b", "Đại học Cần Thơ"),
    (r"\bTruong Dai hoc Can Tho\b", "Trường Đại học Cần Thơ"),
    (r"\bTruong Cong nghe thong tin va truyen thong\b", "Trường Công nghệ thông tin và truyền thông"),
    (r"\bCong nghe thong tin va truyen thong\b", "Công nghệ thông tin và truyền thông"),
    (r"\bPhong Cong tac Sinh vien\b", "Phòng Công tác Sinh viên"),
    (r"\bPhong Dao tao\b", "Phòng Đào tạo"),
    (r"\bDiem ren luyen\b", "Điểm rèn luyện"),
    (r"\bGiay xac nhan sinh vien\b", "Giấy xác nhận sinh viên"),
    (r"\bVay von sinh vien\b", "Vay vốn sinh viên"),
    (r"\bTam hoan nghia vu quan su\b", "Tạm hoãn nghĩa vụ quân sự"),
    (r"\bNgan hang Chinh sach xa hoi\b", "Ngân hàng Chính sách xã hội"),
    (r"\bBo Giao duc va Dao tao\b", "Bộ Giáo dục và Đào tạo"),
    (r"\bBo Tai chinh\b", "Bộ Tài chính"),
    (r"\bHoc sinh, sinh vien\b", "Học sinh, sinh viên"),
    (r"\bHoc vien thac si\b", "Học viên thạc sĩ"),
    (r"\bNghien cuu sinh\b", "Nghiên cứu sinh"),
    (r"\bTo khai thong tin\b", "Tờ khai thông tin"),
    (r"\bCTSV\b", "CTSV"),
    (r"\bP\.\s*CTSV\b", "P. CTSV"),
    (r"\bP\.\s*ĐT\b", "P. ĐT"),
    (r"\bCTU\b", "CTU"),
    (r"\bDHCT\b", "ĐHCT"),
    (r"\bĐHCT\b", "ĐHCT"),
)

# Signs that a recognised line holds a misread special character.
SUSPICIOUS = (r"\?", "Email", "ĐT|Điện thoại", "www|http", r"\(Q|\sQ[A-Za-z0-9]", r"[A-Za-z0-9._%+\-]+\s+[QO0]\s*[A-Za-z0-9.\-]+\.(?:vn|com|edu\.vn)")

ADDRESS = r"([A-Za-z0-9._%+\-]+)\s*[\(\[]?\s*(?:@|Q|O|0|©|ⓐ)\s*([A-Za-z0-9.\-]+\.(?:vn|com|edu\.vn|org|net))"
PHONE = r"\b(ĐT\s*:?\s*|Điện thoại\s*:?\s*)([0-9][0-9 .\-]{7,})"
SCANNER = (r"(?imU)^\s*Scanned\s+with\s+(?:cs\s*)?CamScanner\s*$", r"(?imU)^\s*CamScanner\s*$")
# -------------------------------------------------------------------------------------------------------------------


def apply_rules(c: Column, rules: Iterable[tuple[str, str]], flags: str = "iUd") -> Column:
    """Fold ordered rules into one Column; ``flags``: case, Unicode classes, line feeds only as line ends."""
    for pattern, to in rules:
        c = sub(c, f"(?{flags}){pattern}" if flags else pattern, to)
    return c


def apply_if_any(c: Column, rules: Iterable[tuple[str, str]], flags: str = "iUd") -> Column:
    """As ``apply_rules``; a text that none of the patterns fits, which one pattern of them all tells, is left as it is."""
    rules = tuple(rules)
    inner = [p.removeprefix(r"\b") for p, _ in rules]
    front = r"\b" if all(p.startswith(r"\b") for p, _ in rules) else ""
    any_ = f"(?{flags}){front}(?:{'|'.join(inner if front else (p for p, _ in rules))})"
    return let(c, lambda x: F.when(x.rlike(any_), apply_rules(x, rules, flags)).otherwise(x))


def fix_glyphs(c) -> Column:
    """Glyphs and quotes to their usual forms, no white space (line ends included) inside brackets or before punctuation."""
    x = F.translate(F.coalesce(col(c), F.lit("")), "".join(a for a, _ in GLYPHS), "".join(b for _, b in GLYPHS))
    x = F.replace(F.replace(x, F.lit("''"), F.lit('"')), F.lit("``"), F.lit('"'))
    x = sub(x, r"(?U)\s+([,.;:!?])", "$1")
    x = sub(x, r"(?U)([(\[{“])\s+", "$1")
    return clean_text(sub(x, r"(?U)\s+([)\]}”])", "$1"))


def fix_addresses(c) -> Column:
    """A misread @ before a host name is restored; split urls are joined."""
    fixed = lambda x: sub(sub(sub(x, "(?iU)" + ADDRESS, "$1@$2"), r"(?iU)(https?://)\s+", "$1"), r"(?iU)(www\.)\s+", "$1")
    # an address has a dot inside, a url a slash or a dot
    x = let(F.coalesce(col(c), F.lit("")), lambda x: F.when(x.rlike(r"(?iU)\.(?:vn|com|edu|org|net)|https?://|www\."), fixed(x)).otherwise(x))
    return let(x, lambda x: F.when(F.contains(x, F.lit("/")), sub(x, r"(?U)\s+(/\S*)", "$1")).otherwise(x))


def fix_phones(c) -> Column:
    """White space inside numbers that follow a phone label is taken out; the text between them stays as it is."""
    return let(F.coalesce(col(c), F.lit("")), lambda x: F.when(x.rlike("(?iU)" + PHONE), _fix_phones(x, "(?iU)" + PHONE)).otherwise(x))


def _fix_phones(x: Column, pattern: str) -> Column:
    found = F.regexp_extract_all(x, F.lit(pattern), F.lit(0))
    compact = F.transform(found, lambda m: F.concat(F.regexp_extract(m, pattern, 1), sub(F.regexp_extract(m, pattern, 2), r"(?U)\s+", "")))
    return F.array_join(F.zip_with(F.split(x, pattern, -1), compact, lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")


def fix_terms(c) -> Column:
    return apply_if_any(F.coalesce(col(c), F.lit("")), GENERAL)


def fix_spaces(c) -> Column:
    """Lost spaces: after number words, around quotes, after abbreviations, in glued pairs."""
    x = sub(F.coalesce(col(c), F.lit("")), r"(?U)\b(số|Số)(\d)", "$1 $2")
    x = sub(x, r"(?iU)\b(ngày)(\d{1,2})\b", "$1 $2")
    x = sub(x, "([A-Za-zÀ-ỹ0-9])([“\"])", "$1 $2")
    x = sub(x, "([”\"])([A-Za-zÀ-ỹ0-9])", "$1 $2")
    x = apply_if_any(x, ((rf"\b({short})(?=[A-Za-zÀ-ỹ])", "$1 ") for short in ABBREVIATIONS), "U")
    return clean_text(apply_if_any(x, GLUED))


def fix_dashes(c) -> Column:
    """A question mark between two names was a dash."""
    return let(F.coalesce(col(c), F.lit("")), lambda x: F.when(F.contains(x, F.lit("?")), _fix_dashes(x)).otherwise(x))


def _fix_dashes(x: Column) -> Column:
    x = sub(x, r"(?U)([A-Za-zÀ-ỹ0-9\)]+(?:\s+[A-Za-zÀ-ỹ0-9\)]+){0,4})\?\s+([A-ZĐÀ-Ỹ][A-Za-zÀ-ỹ0-9]+)", "$1 – $2")
    return F.replace(x, F.lit(" ? "), F.lit(" – "))


def general_layer(c) -> Column:
    x = fix_glyphs(fix_dashes(fix_spaces(fix_terms(fix_phones(fix_addresses(fix_glyphs(c)))))))
    lines = lambda x: sub(sub(x, SCANNER[0], ""), SCANNER[1], "")
    return clean_text(let(x, lambda x: F.when(x.rlike("(?iU)camscanner"), lines(x)).otherwise(x)))


def terms_layer(c) -> Column:
    return clean_text(apply_if_any(F.coalesce(col(c), F.lit("")), TERMS))


def is_suspicious(c) -> Column:
    return clean_line(c).rlike("(?iU)" + "|".join(f"(?:{p})" for p in SUSPICIOUS))


@dataclass(frozen=True)
class UserRules:
    """Rules of the user's own: literal replacements, then patterns with flags."""

    literal: tuple[tuple[str, str], ...] = ()
    patterns: tuple[tuple[str, str, str], ...] = ()
    skipped: tuple[str, ...] = field(default=())

    @staticmethod
    def parse(text: str | None) -> UserRules:
        """From JSON: {"replace": {wrong: right}, "regex_replace": [{pattern, replacement, flags}]}. What can't be read is
        no rule; patterns that don't compile are listed in ``skipped``."""
        try:
            data = json.loads(text or "{}")
        except ValueError:
            return UserRules()
        if not isinstance(data, dict):
            return UserRules()
        literal = tuple((str(a), str(b)) for a, b in data["replace"].items()) if isinstance(data.get("replace"), dict) else ()
        patterns, skipped = [], []
        for item in data.get("regex_replace") if isinstance(data.get("regex_replace"), list) else []:
            if isinstance(item, dict) and (pattern := item.get("pattern")):
                try:
                    re.compile(pattern)
                    patterns.append((pattern, str(item.get("replacement", "")), "i" if "i" in str(item.get("flags", "")).lower() else ""))
                except (re.error, TypeError):
                    skipped.append(str(pattern))
        return UserRules(literal, tuple(patterns), tuple(skipped))

    @staticmethod
    def java(replacement: str) -> str:
        """Group references by backslash as Java writes them."""
        out = replacement.replace("$", "\0")
        out = re.sub(r"\\g<(\w+)>|\\(\d+)", lambda m: "${%s}" % m[1] if m[1] and not m[1].isdigit() else "$" + (m[1] or m[2]), out)
        return out.replace("\0", r"\$")

    def __bool__(self) -> bool:
        return bool(self.literal or self.patterns)


def user_layer(c, rules: UserRules) -> Column:
    x = F.coalesce(col(c), F.lit(""))
    for wrong, right in rules.literal:
        if wrong:
            x = F.replace(x, F.lit(wrong), F.lit(right))
    for pattern, to, flags in rules.patterns:
        x = sub(x, f"(?{flags}Ud){pattern}", UserRules.java(to))
    return clean_text(x)


def repair(c, general: bool = True, terms: bool = True, user: UserRules | None = None) -> Column:
    """All layers in order, each of which can be left out."""
    x = clean_text(c)
    if general:
        x = general_layer(x)
    if terms:
        x = terms_layer(x)
    if user:
        x = user_layer(x, user)
    return clean_text(x)
