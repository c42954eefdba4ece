"""Contact-list tables derived from the given ones, in one SQL text for Spark and DuckDB.

Each fixture is SQL over the given tables and earlier fixtures. Where the two dialects differ (arrays, structs), the text has a marker:
``ARR[a; b]`` and ``REC[name := value; ...]``.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages")

FIXTURES = {
    "fx_leads": """
SELECT k AS ord,
  CASE p % 5 WHEN 0 THEN 'Anna' WHEN 1 THEN 'Janis' WHEN 2 THEN 'Elina' WHEN 3 THEN 'Marc' ELSE 'Olga' END AS first_name,
  'Person' || p AS last_name,
  CASE WHEN k % 37 = 0 THEN 'Scanning pages ' || k WHEN k % 41 = 0 THEN '' ELSE (CASE p % 5 WHEN 0 THEN 'Anna' WHEN 1 THEN 'Janis' WHEN 2 THEN 'Elina' WHEN 3 THEN 'Marc' ELSE 'Olga' END) || ' Person' || p END AS name,
  CASE k % 9 WHEN 0 THEN 'CEO' WHEN 1 THEN 'Head of Sales' WHEN 2 THEN 'Design Director' WHEN 3 THEN 'Junior Engineer' WHEN 4 THEN '' WHEN 5 THEN 'Marketing Manager' WHEN 6 THEN 'VP of Finance' WHEN 7 THEN 'Founder & CEO' ELSE 'Intern' END AS title,
  CASE WHEN k % 5 = 0 THEN '' WHEN k % 4 = 1 THEN upper('person' || p || '@corp' || c || tld) ELSE 'person' || p || '@corp' || c || tld END AS email,
  CASE k % 6 WHEN 0 THEN 'verified' WHEN 1 THEN 'risky' WHEN 2 THEN 'invalid' WHEN 3 THEN '' WHEN 4 THEN 'deliverable' ELSE 'missing' END AS email_status,
  CASE WHEN k % 7 = 0 THEN '' ELSE 'https://www.linkedin.com/in/anna-person' || p || '/?t=' || k END AS linkedin_url,
  CASE k % 5 WHEN 0 THEN 'Riga' WHEN 1 THEN 'Berlin' WHEN 2 THEN '' WHEN 3 THEN 'London' ELSE 'Tallinn' END AS city,
  CASE k % 6 WHEN 0 THEN 'Latvia' WHEN 1 THEN 'Germany' WHEN 2 THEN 'United Kingdom' WHEN 3 THEN 'Estonia' WHEN 4 THEN '' ELSE 'Atlantis' END AS country,
  CASE WHEN c % 11 = 0 THEN '' ELSE 'Company ' || c END AS company_name,
  CASE WHEN c % 7 = 0 THEN '' ELSE 'http://www.corp' || c || tld || '/about' END AS company_website,
  CASE WHEN c % 5 = 0 THEN '' ELSE 'https://www.linkedin.com/company/corp' || c END AS company_linkedin,
  CASE k % 4 WHEN 0 THEN '+371' || (20000000 + k) WHEN 1 THEN '' WHEN 2 THEN '+49' || (30000000 + k) ELSE '+44' || (70000000 + k) END AS company_phone,
  CASE WHEN c % 7 = 0 THEN '' ELSE 'corp' || c || tld END AS company_domain,
  CASE WHEN k % 4 < 2 THEN '' WHEN c % 24 = 0 THEN 'Latvia' ELSE 'germany' END AS company_country,
  CASE WHEN k % 8 = 0 THEN '' ELSE c_mktsegment END AS industry,
  CASE k % 3 WHEN 0 THEN 'feed_a' WHEN 1 THEN 'feed_b' ELSE 'feed_c' END AS source,
  CAST(k % 4 AS INT) AS campaign_no
FROM (SELECT c_custkey AS k, c_custkey - c_custkey % 3 AS p, c_custkey - c_custkey % 12 AS c, c_mktsegment,
  CASE (c_custkey - c_custkey % 12) % 5 WHEN 0 THEN '.lv' WHEN 1 THEN '.com' WHEN 2 THEN '.de' WHEN 3 THEN '.co.uk' ELSE '.ee' END AS tld FROM customer) b""",
    "fx_feed_a": """
SELECT ord, first_name, last_name, name, title, email, email_status, linkedin_url, city, country,
  REC[name := company_name; website_url := company_website; linkedin_url := company_linkedin; phone := CASE WHEN ord % 2 = 0 THEN '' ELSE company_phone END; primary_domain := company_domain;
    primary_phone := REC[number := company_phone];
    naics_codes := ARR[REC[naics_description := CASE WHEN ord % 5 = 0 THEN '' ELSE industry END]; REC[naics_description := 'second']];
    sic_codes := ARR[REC[sic_description := 'sic ' || industry]]] AS organization
FROM fx_leads WHERE source = 'feed_a'""",
    "fx_feed_b": """
SELECT ord, first_name, last_name, name AS full_name, title AS job_title, email, linkedin_url AS linkedin, city, country, company_name, company_website, company_linkedin, company_phone, company_domain, industry
FROM fx_leads WHERE source = 'feed_b'""",
    "fx_feed_c": """
SELECT ord, first_name AS firstName, last_name AS lastName, CASE WHEN ord % 2 = 0 THEN '' ELSE name END AS fullName, title AS position, email, linkedin_url AS linkedinUrl, country,
  company_name AS organizationName, company_website AS organizationWebsite, company_linkedin AS organizationLinkedinUrl, lower(industry) AS organizationIndustry
FROM fx_leads WHERE source = 'feed_c'""",
    "fx_pre": """
SELECT ord, first_name, last_name, name, company_phone AS organization_phone, linkedin_url, title, email_status, email, city, country, company_name AS org_name, company_website AS website_url, company_linkedin, company_domain, industry, source
FROM fx_leads WHERE ord % 2 = 0""",
    "fx_raw": """
SELECT ord, '{"linkedin_url":"' || linkedin_url || '","org_name":' || CASE WHEN ord % 3 = 0 THEN '{"name":"x"}' ELSE '"' || company_name || '"' END || CASE WHEN ord % 5 = 0 THEN ',"full_name":"y"}' ELSE '}' END AS raw FROM fx_leads""",
    "fx_places": """
SELECT ord, CASE WHEN ord % 6 = 0 THEN '' ELSE 'place' || (ord - ord % 2) END AS placeId,
  CASE WHEN ord % 10 = 0 THEN '' ELSE 'Shop ' || (ord - ord % 4) END AS title,
  CASE ord % 4 WHEN 0 THEN 'Bakery' WHEN 1 THEN 'Dentist' WHEN 2 THEN 'Gym' ELSE 'Florist' END AS categoryName,
  CASE WHEN ord % 9 = 0 THEN '' ELSE 'Street ' || (ord % 50) || ', Riga' END AS address, 'Street ' || (ord % 50) AS street, 'Riga' AS city, 'LV-' || (1000 + ord % 90) AS postalCode, 'LV' AS countryCode,
  CASE WHEN ord % 3 = 0 THEN '' ELSE '+371' || (20000000 + ord) END AS phone,
  CASE WHEN ord % 4 = 0 THEN '' WHEN ord % 7 = 0 THEN 'https://www.facebook.com/shop' || ord WHEN ord % 11 = 0 THEN 'https://www.delfi.lv/shop' || ord ELSE 'https://shop' || ord || '.lv/' END AS website,
  CASE WHEN ord % 4 = 0 THEN '' WHEN ord % 7 = 0 THEN 'facebook' WHEN ord % 11 = 0 THEN 'delfi.lv' ELSE 'shop' || ord || '.lv' END AS domain, 'https://maps.example/' || ord AS url,
  CASE WHEN ord % 3 = 0 THEN '' ELSE '371' || (20000000 + ord) END AS "phoneUnformatted",
  CASE ord % 4 WHEN 0 THEN ARR['x@gmail.com'] WHEN 1 THEN ARR['a@other.com'; 'info@shop' || ord || '.lv'; 'me@gmail.com'] WHEN 2 THEN ARR['info@shop' || ord || '.lv'] ELSE ARR['a@other.com'; 'old@one.lv'; 'old@one.lv'] END AS emails,
  CASE WHEN ord % 2 = 0 THEN ARR['+3711'; '+3712'] ELSE ARR['+3713'] END AS phones,
  ARR['Shop'; CASE ord % 4 WHEN 0 THEN 'Bakery' WHEN 1 THEN 'Dentist' WHEN 2 THEN 'Gym' ELSE 'Florist' END] AS categories,
  ARR['https://facebook.com/s' || ord; 'https://facebook.com/t'] AS facebooks, CASE WHEN ord % 2 = 0 THEN ARR['https://instagram.com/i' || ord] ELSE ARR[] END AS instagrams, ARR['https://linkedin.com/company/l' || ord] AS "linkedIns",
  CASE WHEN ord % 5 = 0 THEN ARR['https://twitter.com/t' || ord] ELSE ARR[] END AS twitters, CASE WHEN ord % 5 = 1 THEN ARR['https://youtube.com/y' || ord] ELSE ARR[] END AS youtubes,
  CASE WHEN ord % 5 = 2 THEN ARR['https://tiktok.com/k' || ord] ELSE ARR[] END AS tiktoks, CASE WHEN ord % 5 = 3 THEN ARR['https://wa.me/' || ord] ELSE ARR[] END AS whatsapps,
  CAST(1 + ord % 5 AS DOUBLE) AS totalScore, ord % 300 AS reviewsCount, ord % 13 = 0 AS permanentlyClosed,
  CASE ord % 3 WHEN 0 THEN 'bakeries' WHEN 1 THEN 'gyms' ELSE 'florists' END AS niche
FROM (SELECT s_suppkey AS ord FROM supplier UNION ALL SELECT 100000000 + c_custkey FROM customer) s""",
    "fx_business": """
SELECT ord, placeId AS place_id, title AS business_name, categoryName AS category, address, city, '' AS state, postalCode AS zip_code, countryCode AS country, phone, website, url AS google_maps_url, totalScore AS rating, reviewsCount AS review_count,
  CASE WHEN ord % 2 = 0 THEN '$$' ELSE '' END AS price_level, CASE WHEN ord % 3 = 0 THEN 'Mo-Fr 9-17' ELSE '' END AS business_hours, emails, niche, CASE WHEN ord % 2 = 0 THEN NULL ELSE 'https://facebook.com/s' || ord END AS facebook,
  'https://instagram.com/i' || ord AS instagram, CASE WHEN ord % 3 = 0 THEN NULL ELSE 'https://linkedin.com/company/l' || ord END AS linkedin, CASE WHEN ord % 5 = 0 THEN NULL ELSE CAST(ord % 101 AS INT) END AS overall_score, CAST(ord % 99 AS INT) AS performance_score,
  CASE WHEN ord % 4 = 0 THEN 0 ELSE CAST(ord % 97 AS INT) END AS seo_score, CASE WHEN ord % 4 = 0 THEN NULL ELSE ord % 4 = 1 END AS is_mobile_friendly, ord % 3 <> 1 AS has_ssl, CASE WHEN ord % 5 < 2 THEN 'WordPress' ELSE NULL END AS cms,
  CASE ord % 3 WHEN 0 THEN ARR['one'; 'two'; 'three'; 'four'] WHEN 1 THEN ARR['one'] ELSE ARR[] END AS insights, CASE WHEN ord % 6 = 1 THEN NULL ELSE 'Casual ' || ord END AS casual_name, 'About ' || ord AS insight_lv, niche || '_poor' AS segment_id
FROM fx_places""",
    "fx_contacts": """
SELECT website AS site, 'success' AS status, CASE WHEN ord % 5 = 0 THEN 'timeout while reading the first page of the site, which never came' ELSE NULL END AS error, emails, phones AS phone_numbers, CASE WHEN ord % 7 = 1 THEN NULL ELSE 'daily 8-20' END AS business_hours,
  REC[facebook := 'https://facebook.com/s' || ord; twitter := ''; linkedin := 'https://linkedin.com/company/l' || ord; instagram := 'https://instagram.com/i' || ord; youtube := ''; tiktok := ''] AS social,
  REC[name := 'Owner ' || ord; title := 'Owner'; email := 'owner@shop' || ord || '.lv'; phone := ''; linkedin := ''] AS owner,
  CASE WHEN ord % 3 = 0 THEN ARR[REC[name := 'Ann "A" ' || ord; title := 'Baker'; email := 'ann@shop' || ord || '.lv']; REC[name := 'Bob'; title := ''; email := '']] ELSE ARR[REC[name := 'Eve'; title := 'Clerk'; email := 'eve@shop' || ord || '.lv']] END AS team,
  ARR['chat'; 'form'] AS additional_contacts, CAST(ord % 4 AS INT) AS pages_scraped, ord % 2 = 1 AND ord % 3 = 0 AS search_enriched
FROM fx_places WHERE website <> '' AND ord % 2 = 1""",
    "fx_feed_d": """
SELECT ord, first_name, last_name, CASE WHEN ord % 4 = 0 THEN '' ELSE name END AS name, CASE WHEN ord % 3 = 0 THEN company_phone ELSE '' END AS organization_phone, CASE WHEN ord % 2 = 0 THEN '+1' || ord ELSE '' END AS phone, linkedin_url, title, CASE WHEN email_status = '' THEN NULL ELSE email_status END AS email_status,
  email, city, country, CASE WHEN ord % 5 = 0 THEN 'Named ' || ord ELSE '' END AS organization_name, CASE WHEN ord % 6 = 0 THEN company_website ELSE NULL END AS website_url, 'owner' AS seniority, ARR['sales'] AS departments, 'Head line ' || ord AS headline,
  REC[name := company_name; phone := '+371' || ord; website_url := company_website; linkedin_url := company_linkedin; facebook_url := CASE WHEN ord % 2 = 0 THEN NULL ELSE 'https://facebook.com/c' || ord END; estimated_num_employees := CAST(ord % 500 AS INT); founded_year := CASE WHEN ord % 7 = 0 THEN NULL ELSE CAST(1950 + ord % 70 AS INT) END;
    industries := CASE WHEN industry = '' THEN ARR[] ELSE ARR[lower(industry) || ' goods'; 'second'] END; keywords := CASE WHEN ord % 3 = 0 THEN ARR['a'; 'b'; 'c'; 'd'; 'e'; 'f'; 'g'; 'h'; 'i'; 'j'; 'k'; 'l'] ELSE ARR['x'] END] AS organization
FROM fx_leads WHERE source = 'feed_a'""",
    "fx_web_eval": """
SELECT p_partkey AS ord, 'https://site' || p_partkey || '.example' AS site,
  CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE CAST((p_partkey * 13) % 101 AS INT) END AS performance_score,
  CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE CAST((p_partkey * 7) % 101 AS INT) END AS accessibility_score,
  CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE CAST((p_partkey * 17) % 101 AS INT) END AS seo_score,
  CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE CAST((p_partkey * 29) % 101 AS INT) END AS best_practices_score,
  CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE CAST(p_size AS DOUBLE) / 10 END AS lcp_seconds,
  CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE p_partkey % 4 = 1 END AS is_mobile_friendly,
  CASE WHEN p_partkey % 9 = 0 THEN NULL ELSE p_partkey % 3 <> 1 END AS has_ssl,
  CASE p_partkey % 5 WHEN 0 THEN 'WordPress' WHEN 1 THEN 'Wix' ELSE NULL END AS cms,
  CASE p_partkey % 3 WHEN 0 THEN 'bakeries' WHEN 1 THEN 'gyms' ELSE 'florists' END AS niche
FROM part""",
    "fx_profiles": """
SELECT ord, linkedin_url, CASE WHEN ord % 3 = 0 THEN NULL ELSE 'Bio of ' || name END AS bio, CASE WHEN ord % 4 = 0 THEN '' ELSE title END AS professional_title, CASE WHEN ord % 2 = 0 THEN '' ELSE city END AS location,
  CASE WHEN ord % 5 = 0 THEN NULL ELSE company_name END AS company_name, industry AS company_industry, CAST(ord % 30 AS INT) AS total_tenure_years, CASE WHEN ord % 6 = 0 THEN '' ELSE '500-1000' END AS followers_range,
  ARR[REC[position_title := 'A' || ord; company_name := 'C1'; employment_period := '2020']; REC[position_title := 'B'; company_name := 'C2'; employment_period := '2019']; REC[position_title := 'C'; company_name := 'C3'; employment_period := '2018'];
    REC[position_title := 'D'; company_name := 'C4'; employment_period := '2017']; REC[position_title := 'E'; company_name := 'C5'; employment_period := '2016']; REC[position_title := 'F'; company_name := 'C6'; employment_period := '2015']] AS work_experience,
  ARR[REC[institution_name := 'S1'; degree := 'BSc'; attendance_period := '2010']; REC[institution_name := 'S2'; degree := 'MSc'; attendance_period := '2012']; REC[institution_name := 'S3'; degree := 'PhD'; attendance_period := '2015']; REC[institution_name := 'S4'; degree := 'MBA'; attendance_period := '2018']] AS education
FROM fx_leads""",
    "fx_company": """
SELECT DISTINCT company_domain AS domain,
  CASE WHEN length(company_domain) % 3 = 0 THEN '' ELSE 'Latvia' END AS hq_country,
  ARR[REC[country := ''; headquarter := true]; REC[country := 'Estonia'; headquarter := length(company_domain) % 2 = 0]; REC[country := 'Germany'; headquarter := false]] AS locations
FROM fx_leads WHERE company_domain <> ''""",
    "fx_reviewed": """
SELECT ord, name AS "Name", email AS "Email", company_name AS "Company", title AS "Job Title", industry AS "Industry", country AS "Country" FROM fx_leads WHERE ord % 3 <> 1
UNION ALL SELECT 1000000 + ord, 'New ' || ord, 'new' || ord || '@new.lv', 'New Co', 'CEO', industry, 'Latvia' FROM fx_leads WHERE ord % 20 = 0""",
    "fx_reference": """SELECT DISTINCT '  ' || email AS "Email" FROM fx_leads WHERE ord % 10 = 3 AND email <> ''""",
    "fx_campaigns": """
SELECT 'camp_' || c_custkey AS campaign_id, 'Campaign ' || c_name AS campaign_name, CASE c_custkey % 3 WHEN 0 THEN 'leads' ELSE 'places' END AS type,
  CASE WHEN c_custkey % 6 = 5 THEN '' ELSE '2024-0' || (1 + c_custkey % 9) || '-1' || (c_custkey % 10) END AS created_at, CAST(c_custkey * 10 AS BIGINT) AS lead_count, 'client_' || (c_custkey % 5) AS client
FROM customer""",
    "fx_searches": """
SELECT CAST(c_custkey AS BIGINT) AS search_id, 'https://app.example.com/#/people?page=1&personTitles[]=' || CASE c_custkey % 3 WHEN 0 THEN 'sales%20manager' WHEN 1 THEN 'ceo' ELSE 'head%20of%20it' END
  || CASE WHEN c_custkey % 2 = 0 THEN '&personTitles[]=founder' ELSE '' END || '&personLocations[]=' || CASE c_custkey % 4 WHEN 0 THEN 'Latvia' WHEN 1 THEN 'Berlin%2C%20Germany' WHEN 2 THEN 'Atlantis' ELSE 'London%2C%20United%20Kingdom' END
  || '&personSeniorities[]=' || CASE c_custkey % 2 WHEN 0 THEN 'c_suite' ELSE 'vp' END || '&organizationNumEmployeesRanges[]=' || CASE c_custkey % 3 WHEN 0 THEN '1%2C10' WHEN 1 THEN '11%2C50' ELSE '51%2C200' END
  || '&qKeywords=' || lower(c_mktsegment) || CASE WHEN c_custkey % 5 = 0 THEN '' ELSE '&revenueRange[min]=' || (c_custkey % 7) * 1000000 || '&revenueRange[max]=' || (1 + c_custkey % 9) * 5000000 END AS url
FROM customer""",
    "fx_labels": """
SELECT k AS ord, CASE k % 7 WHEN 0 THEN '  Oil and Gas ' WHEN 1 THEN 'BUILDING' WHEN 2 THEN 'real estate/construction' WHEN 3 THEN 'food & drinks or both' WHEN 4 THEN 'information and services/software' WHEN 5 THEN '' ELSE seg END AS industry,
  CASE k % 6 WHEN 0 THEN 'Acme ' || k || ' LLC' WHEN 1 THEN 'Beta ' || k || ', Inc.' WHEN 2 THEN 'Gamma GmbH' WHEN 3 THEN 'SIA Delta ' || k WHEN 4 THEN '' ELSE 'Plain ' || k END AS company,
  CASE k % 6 WHEN 0 THEN 'https://www.linkedin.com/in/jean-paul-van-der-berg/' WHEN 1 THEN 'https://www.linkedin.com/in/art%C5%ABrs-b%C4%93rzi%C5%86%C5%A1-' || (100000 + k) WHEN 2 THEN 'linkedin.com/in/maria-lopez-a1b2c3d4?x=1' WHEN 3 THEN 'https://www.linkedin.com/company/acme' WHEN 4 THEN 'https://linkedin.com/in/o%27neil-123-456789' ELSE '' END AS url,
  CASE k % 5 WHEN 0 THEN '+371 2000' || k WHEN 1 THEN '+49-30-' || k WHEN 2 THEN '+1 (555) ' || k WHEN 3 THEN '00371' || k ELSE '+99877' || k END AS phone,
  CASE k % 5 WHEN 0 THEN 'corp' || k || '.co.uk' WHEN 1 THEN 'WWW.Corp' || k || '.LV' WHEN 2 THEN 'localhost' WHEN 3 THEN 'a.b.corp' || k || '.com' ELSE '' END AS domain,
  CASE k % 4 WHEN 0 THEN 'http://www.corp' || k || '.lv:8080/x?y=1' WHEN 1 THEN 'corp' || k || '.com/about' WHEN 2 THEN '  https://WWW.corp.de/ ' ELSE '' END AS site,
  CASE k % 4 WHEN 0 THEN 'Jānis Bērziņš & Co' WHEN 1 THEN 'Frizētava / salons #1' WHEN 2 THEN '!!!' ELSE 'Plain name ' || k END AS label
FROM (SELECT c_custkey AS k, c_mktsegment AS seg FROM customer) b""",
}
CONFIG = {
    "cfg_phone": ("country, code", [("latvia", "+371"), ("germany", "+49"), ("united kingdom", "+44"), ("estonia", "+372"), ("us", "+1")]),
    "cfg_foreign": ("country, tld", [("latvia", ".de"), ("latvia", ".ee"), ("latvia", ".co.uk"), ("germany", ".lv"), ("germany", ".co.uk"), ("estonia", ".lv")]),
    "cfg_taxonomy": ("v1, v2, prio", [("automotive", "automobile", 1), ("automotive", "vehicles", 2), ("construction", "building", 1), ("machinery", "machinery", 1), ("furniture", "furniture", 1), ("consumer goods", "household", 1), ("consumer goods", "furniture", 2)]),
    "cfg_industry_id": ("id, name, ord", [("5567cd4773696439b10b0000", "Building", 1), ("5567cd4773696439b10b0001", "Automobile", 2), ("5567cd4773696439b10b0002", "Machinery", 3), ("5567cd4773696439b10b0003", "BUILDING", 4)]),
    "cfg_score": ("industry, score, reason, nth", [("BUILDING", "relevant", "core", 3), ("BUILDING", "irrelevant", "first thought", 1), ("automobile", "maybe", "near", 4), ("automobile", "relevant", "too soon", 2), ("MACHINERY", "irrelevant", "far", 5), ("MACHINERY", "irrelevant", "far", 5), ("FURNITURE", "bogus", "shape", 6)]),
    "cfg_source_filter": ("source, filter_key, state", [("feed_a", "titles", "supported"), ("feed_a", "industry", "supported"), ("feed_b", "titles", "supported"), ("feed_b", "industry", "enforceable"), ("feed_b", "revenue", "lost"), ("feed_c", "titles", "enforceable"), ("feed_c", "industry", "enforceable"), ("feed_c", "revenue", "lost")]),
    "cfg_revenue": ("bucket, low, high", [("0-1M", 0, 1000000), ("1-10M", 1000000, 10000000), ("10-50M", 10000000, 50000000), ("50M+", 50000000, 1000000000)]),
    "cfg_size": ("code, bucket, pos", [("1,10", "1-10", 1), ("11,50", "11-20", 1), ("11,50", "21-50", 2), ("51,200", "51-100", 1), ("51,200", "101-200", 2)]),
    "cfg_contact_path": ("pattern", [("contact",), ("/the",), ("about",), ("/en",)]),
    "cfg_country_word": ("word, code, pos", [("latvia", "LV", 1), ("germany", "DE", 2), ("united kingdom", "GB", 3), ("estonia", "EE", 4)]),
}


def _split(text: str) -> list[str]:
    """text at the semicolons that are in no brackets."""
    parts, depth, start = [], 0, 0
    for i, c in enumerate(text):
        depth += c in "[(" or 0
        depth -= c in "])" or 0
        if c == ";" and not depth:
            parts.append(text[start:i])
            start = i + 1
    return [p.strip() for p in [*parts, text[start:]]]


def dialect(sql: str, spark: bool) -> str:
    """sql with its markers written for Spark or for DuckDB."""
    while m := list(re.finditer(r"(ARR|REC)\[", sql)):
        last = m[-1]  # the innermost of the last
        depth, end = 1, last.end()
        while depth:
            depth += {"[": 1, "]": -1}.get(sql[end], 0)
            end += 1
        parts = _split(sql[last.end() : end - 1])
        if last[1] == "ARR":
            parts = [x for x in parts if x]
            out = f"array({', '.join(parts)})" if spark else f"list_value({', '.join(parts)})"
        else:
            pairs = [p.split(":=", 1) for p in parts]
            out = f"named_struct({', '.join(f"'{a.strip()}', {b}" for a, b in pairs)})" if spark else f"struct_pack({', '.join(f'{a.strip()} := {b}' for a, b in pairs).replace(':=', chr(1))})"
        sql = sql[: last.start()] + out + sql[end:]
    sql = sql.replace("\1", ":=")
    return re.sub(r'AS "([A-Za-z ]+)"', r"AS `\1`", sql) if spark else sql.replace("list_value()", "[]::VARCHAR[]")


def _values(name: str) -> str:
    columns, rows = CONFIG[name]
    literal = lambda v: "'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v)
    return f"SELECT * FROM (VALUES {', '.join('(' + ', '.join(map(literal, r)) + ')' for r in rows)}) AS t({columns})"


def _text(name: str, spark: bool) -> str:
    return dialect(FIXTURES[name], spark) if name in FIXTURES else _values(name)


def needed(sql: str) -> list[str]:
    """The fixtures that sql uses, those that others are made of first."""
    out: list[str] = []

    def add(text: str) -> None:
        for name in dict.fromkeys(re.findall(r"\b(?:fx|cfg)_\w+", text)):
            if name in FIXTURES or name in CONFIG:
                if name not in out:
                    add(FIXTURES.get(name, ""))
                    if name not in out:
                        out.append(name)

    add(sql)
    return out


def oracle(sql: str) -> str:
    """DuckDB SQL with the fixtures it uses before it."""
    ctes = ", ".join(f"{n} AS ({_text(n, False)})" for n in needed(sql))
    sql = sql.strip()
    if not ctes:
        return sql
    if sql.upper().startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {ctes}, {sql[15:]}"
    return f"WITH {ctes}, {sql[5:]}" if sql.upper().startswith("WITH ") else f"WITH {ctes} {sql}"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A fixture, or a given table, as a DataFrame."""
    if name in TABLES:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    text = _text(name, True)
    inner = {t: load(spark, sf_dir, t) for t in [*needed(FIXTURES.get(name, "")), *TABLES] if re.search(rf"\b{t}\b", text)}
    text = text.replace("{", "{{").replace("}", "}}") if inner else text
    return spark.sql(re.sub(rf"\b(FROM|JOIN) ({'|'.join(inner)})\b", r"\1 {\2}", text), **inner) if inner else spark.sql(text)
