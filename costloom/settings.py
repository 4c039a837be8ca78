"""Names and texts of one installation. Every job takes them; the defaults are the
placeholders of the reference."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Settings:
    """FIXED VALUES (defaults must equal the reference's for right results)."""

    regional_account_id: str = "082404710867"
    regional_company: str = "COMPANY REGIONAL"
    kube_products: tuple[str, ...] = ("COMPANY.K8S.LOCAL", "COMPANYDEV.K8S.LOCAL")
    hosting_account_name: str = "Hosting"
    infra_company: str = "COMPANY INFRASTRUCTURE"
    marketplace_product: str = "AWS MARKETPLACE"
    marketplace_description_prefix: str = "AWS Marketplace"
    defensive_credit: str = "Defensive credit for Company"
    off_hours_offset_hours: int = 7


DEFAULTS = Settings()
