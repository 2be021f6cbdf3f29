from sheafline.functions import rules, text


def test_clean(each):
    assert each(text.clean_text, [None, " a\t b\r\nc\r\n\n\n\nd \0", ""]) == ["", "a b\nc\n\nd", ""]
    assert each(text.clean_line, [None, "  a \u00a0 b\n c "]) == ["", "a b c"]
    once = each(text.clean_text, ["x \n\n\n\n y"])
    assert each(text.clean_text, once) == once


def test_split_lines(each):
    assert each(text.split_lines, [None, "", "a\r\nb\x85c\n", "\n", "a\n\n"]) == [[], [], ["a", "b", "c"], [""], ["a", ""]]


def test_keys(each):
    assert each(text.match_key, ["  Điều  5. Quyết-định! ", None]) == ["dieu 5 quyet dinh", ""]
    assert each(text.slug, ["Đơn xin học", "Ưu tiên", "!!"]) == ["on-xin-hoc", "uu-tien", "untitled"]
    assert each(text.name_key, ["Bảng A-1"]) == ["banga1"]
    assert each(text.strip_marks, ["e\u0301 Đ ç"]) == ["e D c"]


def test_names(each):
    assert each(text.file_stem, ["/a/b.tar.gz", "/a/.env", "x"]) == ["b.tar", ".env", "x"]
    assert each(text.file_ext, ["/a/B.PDF", "/a/.env", "x"]) == [".pdf", "", ""]
    assert each(text.safe_name, ['/a/q:?r  s.pdf', "/._.md"]) == ["q_r_s", "untitled"]
    long = each(lambda c: text.safe_name(c, 5), ["abcdefghij.md"])[0]
    assert long.startswith("abcde_") and len(long) == 14


def test_markers(each):
    got = each(text.marker, ["1. A b", "2) x", "2.1 y z", "IV. w", "a/ b", "2024 Nội dung", "", "i. x"])
    assert [r["type"] for r in got] == ["number", "number", "number", "roman", "letter", None, None, "roman"]
    assert got[2]["marker"] == "2.1" and got[2]["content"] == "y z"
    assert each(text.starts_item, ["- a", "a.b", "3) x", "text"]) == [True, False, True, False]


def test_caps(each):
    assert each(text.caps_ratio, ["ABc", "123"]) == [2 / 3, 0.0]


def test_rules_golden(each):
    assert each(rules.fix_spaces, ["số16/2016", "phiếu“A”"]) == ["số 16/2016", "phiếu “A”"]
    assert each(rules.fix_addresses, ["abc (Qctu.edu.vn", "abc 0ctu.edu.vn"]) == ["abc@ctu.edu.vn"] * 2
    assert each(rules.fix_terms, ["kỳ han", "thạc sỹ", "đóng dầu", "tin dụng", None]) == ["kỳ hạn", "thạc sĩ", "đóng dấu", "tín dụng", ""]
    assert each(rules.fix_phones, ["Điện thoại: 0292 38 72 728 và ĐT: 12 3456 789 x", "no 1 2 3"]) == ["Điện thoại: 02923872728và ĐT: 123456789x", "no 1 2 3"]
    assert each(rules.fix_dashes, ["truyền thông? Đại học"]) == ["truyền thông – Đại học"]
    assert each(rules.general_layer, ["a\nScanned with CamScanner\nb", "CamScanner"]) == ["a\n\nb", ""]
    assert each(rules.terms_layer, ["ctu dhct", "Diem ren luyen"]) == ["CTU ĐHCT", "Điểm rèn luyện"]
    assert each(rules.is_suspicious, ["a?", "http://x", "plain text"]) == [True, True, False]


def test_user_rules(each):
    user = rules.UserRules.parse('{"replace": {"ab": "x$y"}, "regex_replace": [{"pattern": "(n)(\\\\d)", "replacement": "\\\\2$\\\\1", "flags": "i"}, {"pattern": "("}]}')
    assert user.skipped == ("(",)
    assert each(lambda c: rules.user_layer(c, user), ["ab N5", None]) == ["x$y 5$N", ""]
    assert not rules.UserRules.parse("[1]") and not rules.UserRules.parse("{") and not rules.UserRules.parse(None)
