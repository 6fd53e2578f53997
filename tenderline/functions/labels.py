"""Code vocabularies and the label operator."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# The texts shown for each stored code.
ORDER_STATES = {
    "NEW": "Новый",
    "EXECUTION": "Выполнение",
    "DOCUMENTS_POSTFACTUM": "Документы (постфактум)",
    "ORDER_CLOSED": "Заказ закрыт",
    "ORDER_CANCELED": "Заказ отменен",
    "PAYMENT": "Оплата",
    "PAYMENT_RECEIVED": "Поступление ДС",
    "PARTIAL_POST_PAYMENT_RECEIVED": "Поступление ДС постоплаты",
    "PARTIAL_PRE_PAYMENT_RECEIVED": "Поступление ДС предоплаты",
    "AGREED_BY_SUPPLIER": "Согласование поставщиком",
    "PARTIAL_POST_PAYMENT": "Частичная постоплата",
    "PARTIAL_PRE_PAYMENT": "Частичная предоплата",
    "RECEPTION": "Получение",
    "ORDER_RESULTS": "Редактирование заказа",
    "ORDER_CLOSED_POSTFACTUM": "Заказ закрыт (постфактум)",
    "PAYMENT_POSTFACTUM": "Оплата (постфактум)",
    "ORDER_RESULTS_POSTFACTUM": "Редактирование заказа (постфактум)",
}
PAYMENT_TYPES = {"FULL": "Полная", "PARTIAL": "Частичная", "POSTPAY": "Постоплата"}
ADVANCE_PAYMENT_TYPES = {**PAYMENT_TYPES, "PARTIAL": "Частичная предоплата"}
CONTRACT_STATES = {
    "NEW": "Новый",
    "NOT_ACTIVE": "Неактивный",
    "ACTIVE": "Активный",
    "AGREED": "Согласован",
    "REJECTED": "Отклонен",
    "DELETED": "Удален",
}
SUPPLIER_STATES = {"OPERATIVE": "Рабочий", "POSTFACTUM": "Постфактум"}
REGISTRY_STAGES = {
    "ACTIVE": "Рабочая",
    "BLOCKED": "Блокирована",
    "REGISTERED": "Зарегистрирована",
    "CONFIRMED_BY_ADMIN": "Подтверждена администрацией",
    "CONFIRMED_BY_USER": "Подтверждена пользователем",
    "DISABLED": "Удалена",
}
NO_VAT = "Без НДС"


def label(code: Column, texts: Mapping[str, str]) -> Column:
    """The text of a code; a code without a text stays as it is."""
    pairs = [F.lit(part) for pair in texts.items() for part in pair]
    return F.coalesce(F.create_map(*pairs)[code], code)


def tax_label(rate: Column) -> Column:
    """A VAT rate as text, with the sentinel -1 spelled out."""
    return F.when(rate == -1, F.lit(NO_VAT)).otherwise(rate.cast("string"))
