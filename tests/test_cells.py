from datetime import date, datetime

from padron.functions import cells


def test_strip_covers_all_whitespace(column):
    assert column(cells.strip, [" a ", "\t\na\r\n", " a　", "", None]) == ["a", "a", "a", "", None]


def test_blank_and_text_are_opposites(column):
    values = [None, "", "  ", "\t", "x"]
    assert column(cells.is_blank, values) == [True, True, True, True, False]
    assert column(cells.has_text, values) == [False, False, False, False, True]


def test_header_forms(column):
    assert column(cells.one_line, [" JEFE\r\n INMEDIATO  X "]) == ["JEFE INMEDIATO X"]
    assert column(cells.header_key, [" Año \n mes"]) == ["AÑO MES"]


def test_null_words_are_exact(column):
    assert column(cells.null_words_to_null, ["None", "nan", "NaT", "none", "x", None]) == [None, None, None, "none", "x", None]


def test_error_and_sentinel_codes(column):
    assert column(cells.error_cell_to_null, ["#N/A", "#REF!", "a#", None]) == [None, None, "a#", None]
    values = ["#N/D", "x #N/A", "eRRor 3", "#REF!", "7", None]
    assert column(cells.sentinel_to_null, values) == [None, None, None, "#REF!", "7", None]


def test_imputations(column):
    values = ["0", None, "", "  ", "00", "P"]
    assert column(cells.staff_default, values) == ["Staff", "Staff", "Staff", "Staff", "00", "P"]
    assert column(cells.empty_default, values) == ["0", "Personal_Interno", "Personal_Interno", "  ", "00", "P"]
    assert column(cells.null_default, values) == ["0", "POR DEFINIR", "", "  ", "00", "P"]


def test_number_text(column):
    assert column(cells.number_text, [12.0, 100.0, 0.5, 1.25, -3.1, -0.0, 1e20], "double") == ["12", "100", "0.5", "1.25", "-3.1", "0", "1" + "0" * 20]
    values = [" 12.0 ", "7", "1e2", "a.0", "", None, "1.500", "-0.10", "100", "5.", ".5", "0.1234567", "10.050", "1.2.0"]
    assert column(cells.number_cell_text, values) == [
        "12", "7", "100", "a.0", "", None, "1.5", "-0.1", "100", "5", "0.5", "0.123457", "10.05", "1.2.0",
    ]


def test_strip_dot_zero_only_at_the_end(column):
    assert column(cells.strip_dot_zero, ["12.0", "12.00", "1.05", "x.0"]) == ["12", "12.00", "1.05", "x"]


def test_slash_dates_become_datetime_text_only_when_real(column):
    values = ["1/2/2024", " 31/12/2023 ", "31/02/2024", "1/2/24", "2024-01-01", None]
    expected = ["2024-02-01 00:00:00", "2023-12-31 00:00:00", "31/02/2024", "1/2/24", "2024-01-01", None]
    assert column(cells.slash_date_to_datetime_text, values) == expected


def test_datetime_text_round_trip(column):
    moment = datetime(2024, 2, 1, 13, 5, 9)
    assert column(cells.datetime_text, [moment], "timestamp_ntz") == ["2024-02-01 13:05:09"]
    values = ["2024-02-01 13:05:09", "2024-02-01", "2024-02-30 00:00:00", "x", None]
    assert column(cells.datetime_text_to_date, values) == [date(2024, 2, 1), None, None, None, None]
    both = column(lambda c: cells.datetime_text_to_date(c, date_only=True), values)
    assert both == [date(2024, 2, 1), date(2024, 2, 1), None, None, None]


def test_fraction_is_optional(column):
    values = ["2024-02-01 13:05:09", "2024-02-01 13:05:09.1", "2024-02-01 13:05:09.123456789", "2024-02-01 13:05:09."]
    day = date(2024, 2, 1)
    assert column(cells.fractional_datetime_text_to_date, values) == [day, day, day, None]


def test_five_layouts_and_no_short_years(column):
    day = date(2024, 1, 5)
    values = ["2024-1-5", "5/1/2024", "05-01-2024", "2024/01/05", "5.1.2024", "05/01/24", "31/04/2024", "", None]
    assert column(cells.layout_date, values) == [day] * 5 + [None] * 4


def test_serial_dates(column):
    values = ["45292", "45292.9", "1", "-1", "abc", "99999999", None]
    assert column(cells.serial_date, values) == [
        date(2024, 1, 1), date(2024, 1, 1), date(1899, 12, 31), date(1899, 12, 29), None, None, None,
    ]


def test_sheet_date_tries_everything(column):
    values = ["45292", "2024-01-01 00:00:00", "01/01/2024", "ayer"]
    assert column(cells.sheet_date, values) == [date(2024, 1, 1)] * 3 + [None]
