from cardex.functions.extraction import email_domain, extract_emails, extract_phones
from cardex.functions.sql import register_functions

__all__ = ["email_domain", "extract_emails", "extract_phones", "register_functions"]
