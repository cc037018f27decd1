"""The numbering plan and the standardisation rules as plain SQL, for the oracles."""

from __future__ import annotations

# Region, calling code, trunk prefix, least and greatest length, pattern.
PLAN_ROWS = """
    (1, 'US', '1', '1', 10, 10, '[2-9][0-9]{2}[2-9][0-9]{6}'),
    (2, 'CA', '1', '1', 10, 10, '[2-9][0-9]{2}[2-9][0-9]{6}'),
    (3, 'GB', '44', '0', 9, 10, '[1-9][0-9]{8,9}'),
    (4, 'FR', '33', '0', 9, 9, '[1-9][0-9]{8}'),
    (5, 'DE', '49', '0', 6, 11, '[1-9][0-9]{5,10}'),
    (6, 'ES', '34', '', 9, 9, '[5-9][0-9]{8}'),
    (7, 'IN', '91', '0', 10, 10, '[1-9][0-9]{9}'),
    (8, 'AU', '61', '0', 9, 9, '[2-478][0-9]{8}'),
    (9, 'JP', '81', '0', 9, 10, '[1-9][0-9]{8,9}'),
    (10, 'BR', '55', '0', 10, 11, '[1-9][0-9]{9,10}'),
    (11, 'MX', '52', '', 10, 10, '[1-9][0-9]{9}')
"""


def standardised(source: str, number: str, country: str | None) -> dict[str, str]:
    """Steps that end in `std`: the source's columns plus number, validity and calling code."""
    region = f"coalesce({country}, 'US')" if country else "'US'"

    def fits(prefix: str) -> str:
        return f"{prefix} <> '' and starts_with(d, {prefix}) and length(d) - length({prefix}) between lo and hi"

    return {
        "plan": f"select * from (values {PLAN_ROWS}) v(ord, region, code, trunk, lo, hi, pattern)",
        "first_of_code": "select code, min_by(region, ord) as region from plan group by code",
        "readable": f"select *, regexp_replace({number}, '[^0-9]', '', 'g') as d, starts_with(ltrim({number}), '+') as abroad from {source}",
        "placed": f"""select r.*, case when abroad then coalesce(c2.region, c1.region) else {region} end as region_
            from readable r left join first_of_code c2 on c2.code = substring(d, 1, 2)
            left join first_of_code c1 on c1.code = substring(d, 1, 1) where length(d) >= 2""",
        "cut": f"""select p.*, pl.code, pl.pattern, case
            when pl.region is null then d
            when abroad and trunk <> code and trunk <> '' and starts_with(substring(d, length(code) + 1), trunk)
                 and length(d) - length(code) - length(trunk) between lo and hi then substring(d, length(code) + length(trunk) + 1)
            when abroad then substring(d, length(code) + 1)
            when {fits('trunk')} then substring(d, length(trunk) + 1)
            when length(d) > hi and {fits('code')} then substring(d, length(code) + 1)
            else d end as n from placed p left join plan pl on pl.region = region_""",
        "trimmed": "select *, case when ltrim(n, '0') = '' then '0' else ltrim(n, '0') end as std_number from cut",
        "std": f"""select * exclude (d, abroad, region_, n, code, pattern, std_number), std_number as standardised_phone_number,
            case when pattern is not null and regexp_full_match(std_number, pattern) then 'true' else 'false' end as is_valid_flag,
            code as calling_code from trimmed""",
    }
