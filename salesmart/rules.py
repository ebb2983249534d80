"""Business constants of the marts, gathered in one place.

Every label below is matched or emitted verbatim by the marts, so the values
must stay exactly as written (Cyrillic text, en dash in the age bands).
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

# ---------------------------------------------------------------------------
# These must equal the source system's labels for right results.
# ---------------------------------------------------------------------------
HOME_COMPANY = "Города Новосибирск"
COMPANY_FAMILY_PREFIX = "Города"
RENTAL_OFFICE = "Аренда"
CLOSED_STATUS = "Проведен"
RENTAL_WORD = "аренд"
RENTAL_CONTRACT_NAMES = ("Договор аренды", "Эксклюзивный договор аренды помещения")
DEVELOPER_DEAL_TYPE = "От застройщика"
IN_HOUSE_DEVELOPER = "Риелторское агентство Города"
COMMERCIAL = "Коммерция"
INDUSTRIAL_LAND = "Промназначения"
SUBURBAN_NEW_BUILD = "Загородная новостройка"
NEW_BUILD = "Новостройка"
CATEGORY_RENT = "Аренда"
CATEGORY_SALE = "Продажа"
NO_DATA = "Нет данных"
NOT_LABELLED = "Не размечено"
NOT_GIVEN = "Не указан / ошибка"
ACTIVE_LABEL = "Активен"
DISMISSED_LABEL = "Уволен"
SALES_TEAM_PREFIX = "Команда"
COMMERCIAL_DEPARTMENT = "Отдел коммерческой недвижимости"
AGENT_POSITIONS = (
    "Эксперт по недвижимости",
    "Специалист по недвижимости",
    "Специалист отдела коммерческой недвижимости",
)
SALES_MANAGER_POSITION = "Менеджер отдела продаж"
ASSISTANT_POSITIONS = ("Помощник специалиста", "Помощник менеджера")
SENIOR_AGENT_POSITION = "Старший агент по недвижимости"
AGENT_POSITION = "Агент по недвижимости"
NON_ADMIN_DEPARTMENTS = ("Отдел коммерческой недвижимости", "Декрет", "Группа 0", "Технические аккаунты")
RENTAL_MANAGER_POSITION = "Менеджер отдела аренды"
RENTAL_ASSISTANT_POSITION = "Помощник специалиста"
RENTAL_ADMIN_POSITIONS = ("Администратор", "Руководитель")
RENTAL_SPECIALIST_POSITION = "Специалист по аренде недвижимости"
# Head-count bucket labels, in the order the report lists them.
HEADCOUNT_LABELS = (
    ">24", "7-12", "13-24", "Менеджеры ОП", "Помощники ОП", "Декрет", "Группа 0",
    "АУП ОП", "Менеджеры ОА", "Помощники ОА", "АУП ОА", ">6", "0-3", "4-6",
)
# Age bands (en dash) and tenure bands.
AGE_BANDS = ("18–25", "26–35", "36–45", "46–55", "56+")
EXP_BANDS_HR = ("0-6", "07-12", "13-24", "25+")
EXP_BANDS_RDS = ("24+", "13-24", "07-12", "03-06")
SNAPSHOT_DAY = 5
HEAD_POSITION = "Руководитель"
NEWCOMER_LOOKBACK_DAYS = 2
RETENTION_MONTHS = 5
NO_BIRTHDAY = 9999
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Rules:
    """Parameters of one refresh.  ``as_of`` replaces every ``now()`` of a run."""

    as_of: dt.date
    home_company: str = HOME_COMPANY
    company_prefix: str = COMPANY_FAMILY_PREFIX
    rental_office: str = RENTAL_OFFICE
    closed_status: str = CLOSED_STATUS
    rental_word: str = RENTAL_WORD
    snapshot_day: int = SNAPSHOT_DAY
    newcomer_lookback_days: int = NEWCOMER_LOOKBACK_DAYS
    retention_months: int = RETENTION_MONTHS

    @property
    def rental_pattern(self) -> str:
        return f"%{self.rental_word}%"


#: The run date of the test data. Refresh jobs take no default: they are given the rules of their run.
DEFAULT_RULES = Rules(as_of=dt.date(2000, 6, 20))
